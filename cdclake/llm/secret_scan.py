"""Secret scan: known shapes plus sliding-window entropy, in DataFrame functions only.

Base spans come from three fixed patterns (``assign``, ``access``, ``hex``),
leftmost and non-overlapping for each kind. The ``entropy`` spans are the
method: candidate strings are the long runs of token characters that hold
both a letter and a digit. Over each of them a window of ``WINDOW``
characters slides; the Shannon entropy of its characters is kept up to date
from the counts of the character that leaves and the one that enters. The
alphabet of the whole candidate (hex, alphanumeric, or with the base64
marks) sets the threshold. A candidate that matches the allow list (UUIDs,
slugs and paths of plain words, ...) is skipped. If any window reaches the
threshold, the whole candidate is a span, unless it lies inside a base span,
to which it would add nothing.

Positions come from the text between the matches: its pieces' lengths and the
matches' lengths add up to code-point offsets (end exclusive).

Defined cases: a null or empty text has no spans; repeated rows are scanned
alike; extra columns are kept by :func:`scan` and :func:`redact` (their own
columns, named ``secret_spans`` and so on, replace columns of that name).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The base patterns. Runs are maximal, so the least length can stand in the pattern,
#: except for assign, where a match that is too short still uses up its text.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "entropy"]

#: Candidates of the entropy method, and its window.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Bits a character over which a window counts as random: 20 random characters of the alphabet reach more,
#: written words and numbers less.
BITS = {"hex": 3.0, "alnum": 3.6, "base64": 3.6}
#: Known harmless shapes.
ALLOW = [
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUID
    r"^[0-9/_=+-]+$",  # numbers, dates, rules
    r"^[=_-]*[A-Za-z]+([/_=+-]+([A-Za-z]+|[0-9]{1,8}))*[/_=+-]*$",  # slugs and paths of words and numbers
    r"^[A-Za-z]+[0-9]{1,4}$",  # a word with a number
]


def _lit(pattern: str) -> str:
    """A SQL raw string literal."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _offsets(matches: str, gaps: str) -> str:
    """SQL: the matches' ``start`` and ``end``, from the pieces of text between them."""
    return f"""CASE WHEN size({matches}) = 0 THEN array() ELSE aggregate(
        sequence(0, size({matches}) - 1),
        named_struct('at', 0L, 'out', CAST(array() AS ARRAY<STRUCT<start: BIGINT, end: BIGINT, i: INT>>)),
        (s, i) -> named_struct(
            'at', s.at + length({gaps}[i]) + length({matches}[i]),
            'out', concat(s.out, array(named_struct(
                'start', s.at + length({gaps}[i]), 'end', s.at + length({gaps}[i]) + length({matches}[i]), 'i', i)))),
        s -> s.out) END"""


#: The characters of a candidate; a character's code is its place here, from 1.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Entropies are summed in whole units of this size, so adding and taking away leaves no rounding behind.
UNIT = 2.0**-40


def _random(c: str) -> str:
    """SQL: whether a window of string ``c`` reaches the threshold of its alphabet.

    One step a character: the count of the character that enters the window
    goes up, that of the one that leaves goes down, and the sum of n log2 n
    over the window's characters follows the two counts. Entropy is
    ``log2(w) - sum / w``. The state stays as it is once a window reached the
    threshold.
    """
    w = WINDOW
    weights = ", ".join(f"{round(n * math.log2(n) / UNIT) if n else 0}L" for n in range(w + 1))
    limit = {k: math.floor(w * (math.log2(w) - bits + 1e-9) / UNIT) for k, bits in BITS.items()}
    least = f"""CASE WHEN {c} RLIKE '^[0-9a-fA-F]+$' THEN {limit['hex']}L
        WHEN {c} RLIKE '^[A-Za-z0-9]+$' THEN {limit['alnum']}L ELSE {limit['base64']}L END"""
    codes = f"transform(split({c}, ''), x -> instr('{ALPHABET}', x))"
    # each character beside the one that leaves the window as it enters; 0 where none leaves
    moves = f"""flatten(transform(array({codes}), x ->
        zip_with(x, slice(concat(array_repeat(0, {w}), x), 1, size(x)), (a, b) -> named_struct('comes', a, 'goes', b))))"""
    weight = lambda n: f"get(array({weights}), {n})"
    comes, goes = "get(s.counts, x.comes)", "get(s.counts, x.goes)"
    change = f"""CASE WHEN x.comes = x.goes THEN 0L ELSE {weight(comes + ' + 1')} - {weight(comes)}
        + CASE WHEN x.goes = 0 THEN 0L ELSE {weight(goes + ' - 1')} - {weight(goes)} END END"""
    reached = f"s.at >= {w} AND s.sum <= s.least"
    return f"""aggregate(
        {moves},
        named_struct('at', 0, 'counts', array_repeat(0, {len(ALPHABET) + 1}), 'sum', 0L, 'least', {least}),
        (s, x) -> CASE WHEN {reached} THEN s ELSE named_struct(
            'at', s.at + 1,
            'counts', transform(s.counts, (n, j) -> CASE WHEN j = x.comes AND j = x.goes THEN n
                WHEN j = x.comes THEN n + 1 WHEN j = x.goes AND j > 0 THEN n - 1 ELSE n END),
            'sum', s.sum + {change}, 'least', s.least) END,
        s -> {reached})"""


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``secret_spans``: ``array<struct<start, kind_no, end, kind>>`` ordered by start, then kind."""
    doc = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "secret_spans")).alias("doc")
    steps = docs.select(doc, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "entropy": CANDIDATE}
    for kind, pattern in patterns.items():
        found = f"regexp_extract_all(_text, {_lit(pattern)}, 0)"
        guard = "contains(_text, 'AKIA')" if kind == "access" else "true"
        steps = steps.withColumn(f"_{kind}", F.expr(f"CASE WHEN {guard} THEN {found} ELSE array() END"))
    gaps = {
        f"_{kind}_gaps": F.expr(f"CASE WHEN size(_{kind}) > 0 THEN split(_text, {_lit(pattern)}, -1) END")
        for kind, pattern in patterns.items()
    }
    values = F.expr(f"CASE WHEN size(_assign) > 0 THEN regexp_extract_all(_text, {_lit(ASSIGN)}, 2) END")
    steps = steps.withColumns(gaps | {"_values": values})
    steps = steps.withColumns({f"_{k}_at": F.expr(_offsets(f"_{k}", f"_{k}_gaps")) for k in patterns})
    span = "named_struct('start', {s}, 'kind_no', {n}, 'end', {e}, 'kind', '{k}')"
    base = {
        k: f"transform({at}, p -> {span.format(s='p.start', n=n, e='p.end', k=k)})"
        for n, (k, at) in enumerate(
            {"assign": f"filter(_assign_at, p -> length(_values[p.i]) >= {ASSIGN_LEAST})", "access": "_access_at", "hex": "_hex_at"}.items()
        )
    }
    steps = steps.withColumn("_base", F.expr(f"concat({', '.join(base.values())})"))
    allowed = " OR ".join(f"c RLIKE {_lit(p)}" for p in ALLOW)
    suspect = f"c RLIKE '[0-9]' AND c RLIKE '[A-Za-z]' AND NOT ({allowed})"
    suspects = f"filter(_entropy_at, p -> exists(array(_entropy[p.i]), c -> {suspect}))"
    random = f"filter({suspects}, p -> exists(array(_entropy[p.i]), c -> {_random('c')}))"
    entropy = f"""filter(transform({random}, p -> {span.format(s='p.start', n=3, e='p.end', k='entropy')}),
        x -> NOT exists(_base, b -> b.start <= x.start AND b.end >= x.end))"""
    steps = steps.withColumn("_more", F.expr(f"CASE WHEN size(_entropy_at) > 0 THEN {entropy} ELSE array() END"))
    return steps.select("doc.*", F.expr("array_sort(concat(_base, _more))").alias("secret_spans"))


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of the text replaced by ``mask``; overlapping spans become one mask. Null texts stay null."""
    text = f"`{text_col}`"
    clean = f"""CASE WHEN size(secret_spans) = 0 THEN {text} ELSE aggregate(
        secret_spans,
        named_struct('at', 0L, 'out', ''),
        (s, x) -> CASE WHEN x.start >= s.at OR s.at = 0
            THEN named_struct('at', x.end, 'out', concat(s.out, substr({text}, CAST(s.at + 1 AS INT), CAST(x.start - s.at AS INT)), '{mask}'))
            ELSE named_struct('at', greatest(s.at, x.end), 'out', s.out) END,
        s -> concat(s.out, substr({text}, CAST(s.at + 1 AS INT)))) END"""
    return scan(docs, text_col).withColumn(text_col, F.expr(clean)).select(*[f"`{c}`" for c in docs.columns])


def digests(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind, SHA-256 of the base spans' text form, and all spans in that form."""
    joined = lambda spans: (
        f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    )
    count = lambda kind: F.expr(f"CAST(size(filter(secret_spans, x -> x.kind = '{kind}')) AS BIGINT)").alias(f"n_{kind}")
    return scanned.select(
        id_col,
        *(count(k) for k in KINDS[:3]),
        F.expr(f"sha2({joined('filter(secret_spans, x -> x.kind_no < 3)')}, 256)").alias("base_sha256"),
        F.expr(joined("secret_spans")).alias("spans"),
    )


#: The same rows in DuckDB; the entropy of each window is computed afresh instead of incrementally.
_DUCK_AT = """list_transform(range(len(m)), lambda i: {{'s': list_sum(list_transform(range(i + 1), lambda j: length(g[j + 1]))) + coalesce(list_sum(list_transform(range(i), lambda j: length(m[j + 1]))), 0),
   'x': m[i + 1], 'v': {value}}})"""


def _duck_found(name: str, pattern: str, value: str = "''") -> str:
    """CTE with start, text and (for assign) value of each match."""
    lit = "'" + pattern.replace("'", "''") + "'"
    values = f"regexp_extract_all(t, {lit}, 2)" if value != "''" else "[]"
    return f"""{name} AS (SELECT rid, CAST(f.s AS BIGINT) AS s, CAST(f.s AS BIGINT) + length(f.x) AS e, f.x AS x, f.v AS v FROM (
  SELECT rid, unnest({_DUCK_AT.format(value=value)}) AS f FROM (
    SELECT rid, regexp_extract_all(t, {lit}, 0) AS m, string_split_regex(t, {lit}) AS g, {values} AS val
    FROM docs WHERE regexp_matches(t, {lit}))))"""


def oracle() -> str:
    w = WINDOW
    not_allowed = " AND ".join(f"NOT regexp_matches(x, '{p}')" for p in ALLOW)
    window = f"substr(x, CAST(i + 1 AS BIGINT), {w})"
    window_sum = (
        f"list_sum(list_transform(list_transform(list_distinct(string_split({window}, '')), "
        f"lambda c: {w} - length(replace({window}, c, ''))), lambda k: k * log2(k)))"
    )
    return f"""WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
{_duck_found('assign', ASSIGN, 'val[i + 1]')},
{_duck_found('access', ACCESS)},
{_duck_found('hex', HEX.replace('(?<![0-9a-f])', ''))},
{_duck_found('cand', CANDIDATE.replace('(?<![A-Za-z0-9+/_=-])', ''))},
base AS (
  SELECT rid, s, 0 AS kn, e, 'assign' AS kind FROM assign WHERE length(v) >= {ASSIGN_LEAST}
  UNION ALL SELECT rid, s, 1, e, 'access' FROM access
  UNION ALL SELECT rid, s, 2, e, 'hex' FROM hex),
win AS (
  SELECT DISTINCT rid, s, e FROM (
    SELECT rid, s, e, x, {window_sum} AS total FROM (
      SELECT rid, s, e, x, unnest(range(length(x) - {w} + 1)) AS i FROM cand
      WHERE regexp_matches(x, '[0-9]') AND regexp_matches(x, '[A-Za-z]') AND {not_allowed}))
  WHERE total <= {w} * (log2({w}) - CASE WHEN regexp_matches(x, '^[0-9a-fA-F]+$') THEN {BITS['hex']}
      WHEN regexp_matches(x, '^[A-Za-z0-9]+$') THEN {BITS['alnum']} ELSE {BITS['base64']} END) + 1e-9 * {w}),
every AS (
  SELECT * FROM base
  UNION ALL SELECT rid, s, 3, e, 'entropy' FROM win
  WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.rid = win.rid AND base.s <= win.s AND base.e >= win.e)),
per AS (
  SELECT rid, count(*) FILTER (kn = 0) AS n_assign, count(*) FILTER (kn = 1) AS n_access, count(*) FILTER (kn = 2) AS n_hex,
    coalesce(string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, kn, e) FILTER (kn < 3), '') AS base_text,
    string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, kn, e) AS spans
  FROM every GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base_text, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN per USING (rid)"""
