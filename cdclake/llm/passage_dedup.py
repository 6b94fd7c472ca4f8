"""Substring deduplication by hashing normalised units of text.

A text is cut into units at line ends, after sentence marks, and before a
capitalised word (where a passage pasted into a line starts). A unit is
normalised (lower case, words only) and hashed to 64 bits. The digests are
grouped over all documents; of each digest the occurrence in the document
with the smallest id, and the first one inside a document, is the earliest
and stays. Later occurrences are repeats. Repeats that follow each other make
a run. A passage that starts or ends inside a sentence leaves parts of units
at the run's two ends, so a run is extended into the units beside it, word by
word, as far as they read like the units beside the earliest occurrence of its
first and last unit (``MIN_BORDER`` words at least; fewer are taken for
chance). A run of ``MIN_WORDS`` words or more is removed from its document.

Lines and paragraphs (lines without a blank one between them) are units too.
Each one of ``MIN_BLOCK`` words or more that is repeated as a whole is removed
by itself, in however short a run. What stays is repeated lines and paragraphs
below that (headings, licence lines, common phrases; ``min_block=1`` removes
these as well), shorter runs inside a line, and passages that hold no whole
unit. The removed spans keep their offsets in the original text (code points,
end exclusive).

Spark does the global part: documents give one row per distinct digest, a
counting aggregation (combined before the shuffle) finds shared digests, and
a join, which adaptive execution splits when a digest is very common, gives
each document its repeated digests. Only the units beside a run that could
reach ``MIN_WORDS`` with them, and those beside the occurrences they are
compared with, are read again as text. Nothing is collected per digest.

Defined cases: a null or empty text has no units; rows that share an id count
as one document (repeats between them stay), each text with its own spans, and rows without an id rank
last, those with the same text as one document; empty tables give empty results; extra columns are kept
by :func:`remove` and ignored otherwise.
"""

from __future__ import annotations

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cdclake.llm.common import known_id, map_texts, stage

#: Least words of a run of repeated units that is removed.
MIN_WORDS = 40
#: Least words of a repeated line or paragraph that is removed by itself.
MIN_BLOCK = 15
#: Least words by which a run is extended into the unit beside it.
MIN_BORDER = 3

_CUT = regex.compile(r"\s*\n\s*|(?<=[.!?…][\"'»”’)\]]?)\s+|\s+(?=\p{Lu}\p{Ll})")
_NO_WORD = regex.compile(r"\W+")
_WORD = regex.compile(r"\w+")


def units(text: str | None) -> list[tuple[int, int, int, int]]:
    """``(digest, start, end, words)`` of every unit that has a word."""
    if not text:
        return []
    found = []
    start = 0
    for cut in [*_CUT.finditer(text), None]:
        end = cut.start() if cut else len(text)
        if words := _normalised(text[start:end]):
            found.append((_digest(words), start, end, len(words)))
        start = cut.end() if cut else end
    return found


def _normalised(text: str) -> list[str]:
    return _NO_WORD.sub(" ", text.lower()).split()


def _digest(words: list[str]) -> int:
    digest = xxhash.xxh64_intdigest(" ".join(words))
    return digest - (1 << 64) if digest >> 63 else digest


def blocks(text: str | None, least: int = MIN_BLOCK) -> list[tuple[int, int, int]]:
    """``(digest, start, end)`` of every line, and every paragraph of several lines, that has ``least`` words."""
    found = []
    paragraph: list[str] = []
    lines, first, last, start = 0, 0, 0, 0
    for line in [*text.split("\n"), None] if text else ():
        words = _normalised(line) if line is not None else []
        if words:
            begin = start + len(line) - len(line.lstrip())
            first, last = (first if lines else begin), start + len(line.rstrip())
            paragraph += words
            lines += 1
            if len(words) >= least:
                found.append((_digest(words), begin, last))
        elif line is None or not line.strip():
            if lines > 1 and len(paragraph) >= least:
                found.append((_digest(paragraph), first, last))
            paragraph, lines = [], 0
        start += len(line) + 1 if line is not None else 0
    return found


def repeated_blocks(found, digests, starts, shared: set[int]) -> list[tuple[int, int]]:
    """Spans of the blocks that an earlier document has (``shared``), or this one further up, as a block or a unit."""
    first: dict[int, int] = {}
    for digest, start in [*zip(digests, starts, strict=True), *((d, s) for d, s, _ in found)]:
        first[digest] = min(start, first.get(digest, start))
    return [(s, e) for d, s, e in found if d in shared or first[d] < s]


def united(spans) -> list[tuple[int, int]]:
    """The spans in order, those that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def runs(digests, words, shared: set[int]) -> list[tuple[int, int, int]]:
    """First and last unit and words of every run of repeated units. ``shared``: digests that an earlier document has."""
    found, seen, size = [], set(), 0
    first = last = -1
    for i, digest in enumerate([*digests, None]):
        if digest is not None and (digest in shared or digest in seen):
            first = i if size == 0 else first
            size += words[i]
            last = i
            continue
        if size:
            found.append((first, last, int(size)))
        size = 0
        seen.add(digest)
    return found


def repeated_runs(digests, starts, ends, words, shared: set[int], least: int) -> list[tuple[int, int]]:
    """Spans of runs of repeated units with at least ``least`` words. ``shared``: digests that an earlier document has."""
    return [(int(starts[a]), int(ends[b])) for a, b, size in runs(digests, words, shared) if size >= least]


def _side(run: int, right: bool, digest: int, starts, ends, unit: int, earlier: int) -> dict:
    """The unit beside a run, and in the same text the one beside the earlier occurrence (-1: not in this text)."""
    there = 0 <= earlier < len(starts)
    return {
        "run": run, "right": right, "digest": digest, "start": starts[unit], "end": ends[unit],
        "from": starts[earlier] if there else -1, "to": ends[earlier] if there else -1,
    }


def sides(digests, starts, ends, words, shared: set[int], least: int, found) -> list[dict]:
    """The units beside each run that reaches ``least`` words with them at the most."""
    out: list[dict] = []
    places: dict[int, int] = {}
    for i, digest in enumerate(digests):
        places.setdefault(digest, i)
    for k, (a, b, size) in enumerate(found):
        left, right = words[a - 1] if a else 0, words[b + 1] if b + 1 < len(digests) else 0
        if size + left + right < least:
            continue
        for beside, unit, step in ((left, a, -1), (right, b, 1)):
            if beside < MIN_BORDER:
                continue
            inside = digests[unit] not in shared  # the earlier occurrence is in this text
            earlier = places[digests[unit]] + step if inside else -1
            if not inside or 0 <= earlier < len(digests):
                out.append(_side(k, step == 1, digests[unit], starts, ends, unit + step, earlier))
    return out


def gained(right: bool, start: int, mine: str, theirs: str | None) -> tuple[int, int]:
    """Words at the run's side of the unit ``mine`` that ``theirs`` has too, and the offset up to which they reach."""
    step = 1 if right else -1
    own = list(_WORD.finditer(mine))[::step]
    other = _WORD.findall(theirs or "")[::step]
    n = 0
    while n < min(len(own), len(other)) and own[n].group().lower() == other[n].lower():
        n += 1
    return n, start + (own[n - 1].span()[right] if n else 0)


def extended(found, gains, least: int) -> list[tuple[int, int]]:
    """Spans of the runs ``(start, end, words)`` that have ``least`` words with what they gained ``(run, right, words, at)``."""
    reach = {(r, bool(right)): (n, at) for r, right, n, at in gains if n >= MIN_BORDER}
    spans: list[tuple[int, int]] = []
    for k, (start, end, size) in enumerate(found):
        left, right = reach.get((k, False), (0, start)), reach.get((k, True), (0, end))
        if size + left[0] + right[0] < least:
            continue
        start, end = left[1], right[1]
        if spans and start <= spans[-1][1]:  # both reach into the unit between
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    return spans


#: A row's key: repeated ids may have different texts.
KEY = ["id", "text_hash"]


def _key(id_col: str, text_col: str):
    return known_id(id_col, text_col).alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash")


def text_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_block: int = MIN_BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``id`` (never null), ``text_hash``, the units' digests, starts, ends and word
    counts, and the ``blocks`` (lines and paragraphs)."""
    prepared = docs.select(*_key(id_col, text_col), F.col(f"`{text_col}`").alias("text"))
    lists = ["digests", "starts", "ends", "words"]
    schema = StructType.fromDDL(
        "id bigint, text_hash bigint, digests array<bigint>, starts array<int>, ends array<int>, words array<int>, "
        "blocks array<struct<digest: bigint, start: int, end: int>>"
    )

    def make():
        def work(ids, hashes, texts):
            found = [np.array(units(t), np.int64).reshape(-1, 4).T for t in texts]
            whole = [[{"digest": d, "start": s, "end": e} for d, s, e in blocks(t, min_block)] for t in texts]
            return {"id": ids, "text_hash": hashes, "digests": [f[0] for f in found], "blocks": whole} | {
                n: [f[k].astype(np.int32) for f in found] for k, n in enumerate(lists) if k
            }

        return work

    return map_texts(prepared, make, schema, *KEY, "text")


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_block: int = MIN_BLOCK
) -> DataFrame:
    """``id``, ``text_hash``, ``n_units`` and ``spans`` (``array<struct<start, end>>`` to remove) of every row of ``docs``."""
    table = stage(text_units(docs, id_col, text_col, min_block), "units")
    each = table.select("id", F.explode(F.array_union("digests", F.col("blocks.digest"))).alias("digest"))
    earliest = each.groupBy("digest").agg(F.min("id").alias("earliest"), F.max("id").alias("latest"))
    shared = stage(earliest.where("latest > earliest").select("digest", "earliest"), "shared")
    repeats = (
        each.join(shared, "digest")
        .where(F.col("id") > F.col("earliest"))
        .groupBy("id")
        .agg(F.collect_set("digest").alias("shared"))  # at most one document's own units
    )
    found = stage(_runs(table.join(repeats, "id", "left"), min_words), "runs")
    gains = _gains(docs, table, shared, found, id_col, text_col)
    joined = found.join(gains, KEY, "left")

    def make():
        def work(ids, hashes, n_units, found, whole, gains):
            spans = []
            for f, w, g_ in zip(found, whole, gains, strict=True):
                long = extended([tuple(r.values()) for r in f], [tuple(g.values()) for g in g_ or ()], min_words)
                spans.append([{"start": s, "end": e} for s, e in united([*long, *(tuple(b.values()) for b in w)])])
            return {"id": ids, "text_hash": hashes, "n_units": n_units, "spans": spans}

        return work

    schema = "id bigint, text_hash bigint, n_units int, spans array<struct<start: int, end: int>>"
    return map_texts(joined, make, schema, *KEY, "n_units", "runs", "whole", "gains")


_SIDES = "array<struct<run: int, right: boolean, digest: bigint, start: int, end: int, from: int, to: int>>"


def _runs(joined: DataFrame, min_words: int) -> DataFrame:
    """``id``, ``text_hash``, ``n_units``, ``runs``, ``whole`` (repeated blocks) and ``sides`` of every row."""

    def make():
        def work(ids, hashes, digests, starts, ends, words, in_text, shared):
            rows, whole, beside = [], [], []
            for d, s, e, w, b, x in zip(digests, starts, ends, words, in_text, shared, strict=True):
                x = set(x or ())
                spans = repeated_blocks([tuple(k.values()) for k in b], d, s, x)
                whole.append([{"start": start, "end": end} for start, end in spans])
                found = runs(d, w, x)
                rows.append([{"start": s[a], "end": e[b], "words": n} for a, b, n in found])
                beside.append(sides(d, s, e, w, x, min_words, found))
            return {"id": ids, "text_hash": hashes, "n_units": [len(d) for d in digests], "runs": rows, "whole": whole, "sides": beside}

        return work

    schema = f"id bigint, text_hash bigint, n_units int, runs array<struct<start: int, end: int, words: int>>, whole array<struct<start: int, end: int>>, sides {_SIDES}"
    return map_texts(joined, make, schema, *KEY, "digests", "starts", "ends", "words", "blocks", "shared")


def _gains(docs: DataFrame, table: DataFrame, shared: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``text_hash`` and ``gains``: how far the runs of a row reach into the units beside them."""
    asked = found.where("size(sides) > 0").select(*KEY, "sides").dropDuplicates(KEY)
    wanted = asked.select(F.explode("sides").alias("s")).where("s.from < 0").select("s.digest", "s.right").distinct()
    wanted = (
        wanted.join(shared, "digest")
        .groupBy(F.col("earliest").alias("id"))
        .agg(F.collect_list(F.struct("digest", "right")).alias("wanted"))  # at most one document's own units, twice
    )

    def make_owned():
        def work(ids, hashes, digests, starts, ends, wanted):
            out = []
            for d, s, e, want in zip(digests, starts, ends, wanted, strict=True):
                places = {}
                for i, digest in enumerate(d):
                    places.setdefault(digest, i)
                here = [(w["digest"], w["right"], places[w["digest"]] + (1 if w["right"] else -1)) for w in want if w["digest"] in places]
                out.append([_side(-1, right, digest, s, e, i, -1) for digest, right, i in here if 0 <= i < len(d)])
            return {"id": ids, "text_hash": hashes, "sides": out}

        return work

    owned = map_texts(
        table.join(wanted, "id"), make_owned, f"id bigint, text_hash bigint, sides {_SIDES}", *KEY, "digests", "starts", "ends", "wanted"
    ).dropDuplicates(KEY)
    both = asked.unionByName(owned).groupBy(*KEY).agg(F.flatten(F.collect_list("sides")).alias("sides"))
    texts = docs.select(*_key(id_col, text_col), F.col(f"`{text_col}`").alias("text")).join(both, KEY)

    def make_pieces():
        def work(ids, hashes, texts, beside):
            out: dict[str, list] = {n: [] for n in ("id", "text_hash", "run", "right", "digest", "start", "mine", "theirs")}
            for i, h, text, each in zip(ids, hashes, texts, beside, strict=True):
                for s in each:
                    there = text[s["from"] : s["to"]] if s["from"] >= 0 else None
                    row = (i, h, s["run"], s["right"], s["digest"], s["start"], text[s["start"] : s["end"]], there)
                    for column, value in zip(out.values(), row, strict=True):
                        column.append(value)
            return out

        return work

    schema = "id bigint, text_hash bigint, run int, right boolean, digest bigint, start int, mine string, theirs string"
    pieces = stage(map_texts(texts, make_pieces, schema, *KEY, "text", "sides"), "pieces")
    # several texts under the earliest id: the smallest piece, so the choice is always the same
    # (written first, so that the join takes over no partitioning and a common digest can be split)
    beside = stage(pieces.where("run < 0").groupBy("digest", "right").agg(F.min("mine").alias("first")), "beside")
    compared = pieces.where("run >= 0").join(beside, ["digest", "right"], "left").withColumn("theirs", F.coalesce("theirs", "first"))

    def make_gains():
        def work(ids, hashes, run, right, start, mine, theirs):
            got = [gained(*x) for x in zip(right, start, mine, theirs, strict=True)]
            return {"id": ids, "text_hash": hashes, "run": run, "right": right, "words": [n for n, _ in got], "at": [at for _, at in got]}

        return work

    schema = "id bigint, text_hash bigint, run int, right boolean, words int, at int"
    gains = map_texts(compared, make_gains, schema, *KEY, "run", "right", "start", "mine", "theirs")
    gain = F.struct("run", "right", "words", "at")
    return gains.where(F.col("words") >= MIN_BORDER).groupBy(*KEY).agg(F.collect_set(gain).alias("gains"))


def kept_pieces(spans: str = "spans", length: str = "length(text)") -> str:
    """SQL: the original ``start`` and ``end`` of the pieces that stay."""
    return f"""filter(transform(sequence(0, size({spans})), i -> named_struct(
        'start', CASE WHEN i = 0 THEN 0 ELSE {spans}[i - 1].end END,
        'end', CASE WHEN i = size({spans}) THEN {length} ELSE {spans}[i].start END)), p -> p.end > p.start)"""


def remove(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the spans cut out of the text, plus ``removed_spans`` and ``kept_spans`` in original offsets."""
    found = spans.where("size(spans) > 0").select(*KEY, F.col("spans").alias("found")).dropDuplicates(KEY)
    text = f"doc.`{text_col}`"
    packed = docs.drop("removed_spans", "kept_spans").select(F.struct("*").alias("doc"), *_key(id_col, text_col))
    none = F.expr("CAST(array() AS array<struct<start: int, end: int>>)")
    joined = packed.join(found, KEY, "left").withColumn("removed", F.coalesce("found", none))
    joined = joined.withColumn("kept", F.expr(kept_pieces("removed", f"length({text})")))
    cut = f"""CASE WHEN size(removed) = 0 THEN {text} ELSE
        array_join(transform(kept, p -> substr({text}, p.start + 1, p.end - p.start)), '') END"""
    columns = [F.expr(cut).alias(c) if c == text_col else F.col(f"doc.`{c}`") for c in docs.columns if c not in ("removed_spans", "kept_spans")]
    return joined.select(*columns, F.col("removed").alias("removed_spans"), F.col("kept").alias("kept_spans"))
