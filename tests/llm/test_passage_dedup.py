import random
import re

from cdclake.llm import passage_dedup as d
from tests.llm.conftest import rows


def brute(texts, least=d.MIN_WORDS):
    """Spans to remove per id, by walking over the documents in order of their ids."""
    known, out = set(), {}
    for key, text in sorted(texts, key=lambda x: x[0]):
        units = d.units(text)
        digests, starts, ends, words = zip(*units, strict=True) if units else [()] * 4
        whole = d.blocks(text)
        spans = d.repeated_runs(digests, starts, ends, words, known, least)
        out[key] = d.united([*spans, *d.repeated_blocks(whole, digests, starts, known)])
        known |= {u[0] for u in [*units, *whole]}
    return out


def passage(prose, i):
    words = prose[i].split()
    return " ".join(words[:30]).capitalize() + ". " + " ".join(words[30:60]).capitalize() + "."


def test_units_and_offsets():
    text = "One two. Three\n  four, five Six seven!  \n\n...\nend"
    assert [text[s:e] for _, s, e, _ in d.units(text)] == ["One two.", "Three", "four, five", "Six seven!", "end"]
    assert [u[3] for u in d.units(text)] == [2, 1, 2, 2, 1]
    assert d.units("One  TWO,")[0][0] == d.units("one two!")[0][0]
    assert d.units(None) == d.units("") == d.units(" \n. . .") == []


def test_passages_pasted_into_lines_are_found(spark, prose):
    shared = passage(prose, 0)
    texts = [
        (1, f"{prose[1]}\n{shared}\n{prose[2]}"),
        (2, f"{prose[3]} and some more {shared} {prose[4].lower()}"),
        (3, f"{prose[5]}\nAll rights reserved.\n"),
        (4, f"{prose[6]}\nAll rights reserved.\n{shared.upper()}"),
        (5, prose[7] + "\n" + prose[7]),
        (6, prose[1]),
    ]
    table = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = {r.id: [tuple(s) for s in r.spans] for r in d.repeated_spans(table).collect()}
    assert found == brute(texts)
    cut = {r.doc_id: r for r in d.remove(table, d.repeated_spans(table)).collect()}
    by_id = dict(texts)
    assert [by_id[2][s:e] for s, e in cut[2].removed_spans] == [shared]
    assert cut[1].removed_spans == cut[3].removed_spans == []
    assert cut[1].text == by_id[1] and cut[3].text == by_id[3]
    assert shared not in cut[2].text and cut[2].text == "".join(by_id[2][s:e] for s, e in cut[2].kept_spans)
    assert cut[5].text == prose[7] + "\n" and cut[6].text == ""
    # offsets cover the original text
    for key, r in cut.items():
        assert sorted([*r.removed_spans, *r.kept_spans])[0][0] == 0
        assert sum(e - s for s, e in [*r.removed_spans, *r.kept_spans]) == len(by_id[key])


def test_passages_that_start_and_end_inside_sentences(spark):
    """Passages of 51 to 75 words between other words of the same sentences, all found and cut to the word."""
    rng = random.Random(8)
    stems = ["".join(rng.choice("aeiou") + rng.choice("bdglmnrst") for _ in range(3)) for _ in range(2000)]
    word = lambda n: [rng.choice(stems) for _ in range(n)]
    texts, passages = [], {}
    for i, size in enumerate(range(51, 76)):
        head, tail = rng.randint(8, 18), rng.randint(8, 18)
        passage = " ".join(word(head)) + ". " + " ".join(word(size - head - tail)).capitalize() + ". " + " ".join(word(tail)).capitalize()
        for k in (0, 100):
            before, after = " ".join(word(30)).capitalize() + f" k{k}a", f"k{k}b " + " ".join(word(30)) + "."
            texts.append((i + k, f"{before} {passage} {after}"))
        passages[i + 100] = passage
    table = spark.createDataFrame(texts, "doc_id bigint, text string")
    by_id = dict(texts)
    cut = {r.doc_id: [by_id[r.doc_id][s:e] for s, e in r.removed_spans] for r in d.remove(table, d.repeated_spans(table)).collect()}
    assert {k: v for k, v in cut.items() if v} == {k: [p] for k, p in passages.items()}
    # the middle sentences alone are too short
    assert any(not v for k, v in brute(texts).items() if k >= 100)


def test_blocks():
    text = "One two three.  Four\n  five six \n\n\nseven eight nine ten\n...\nten"
    assert [text[s:e] for _, s, e in d.blocks(text, 4)] == [
        "One two three.  Four", "One two three.  Four\n  five six", "seven eight nine ten", "seven eight nine ten\n...\nten",
    ]
    assert [text[s:e] for _, s, e in d.blocks(text, 5)] == ["One two three.  Four\n  five six", "seven eight nine ten\n...\nten"]
    assert d.blocks("ONE, two", 2)[0][0] == d.units("one two")[0][0]
    assert d.blocks(None) == d.blocks("") == d.blocks("\n \n...", 1) == []


def test_repeated_lines_and_paragraphs_go_by_themselves(spark, prose):
    """A line of 37 words in six documents, a paragraph of short lines, a repeat inside one text; short lines stay."""
    line = " ".join(prose[0].split()[:37])
    lines = ["alpha beta gamma delta", "epsilon zeta eta theta", "iota kappa lambda mu", "nu xi omicron pi rho"]
    block = "\n".join(lines)
    texts = [(i, f"{prose[i]}\n{line}\nnumber {i}") for i in range(1, 7)]
    texts += [(7, f"{prose[7]}\n\n{block}\n\nnumber 7"), (8, f"{prose[8]}\n\n{block.upper()}\n \nnumber 8")]
    texts += [(9, f"{prose[9]}\n{lines[0]}\n\n{lines[1]}"), (10, f"{line} x\n{line} x\n")]
    table = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = d.repeated_spans(table)
    by_id = dict(texts)
    cut = {r.doc_id: [by_id[r.doc_id][s:e] for s, e in r.removed_spans] for r in d.remove(table, found).collect()}
    assert cut == {1: []} | {i: [line] for i in range(2, 7)} | {7: [], 8: [block.upper()], 9: [], 10: [f"{line} x"]}
    assert {r.id: [tuple(s) for s in r.spans] for r in found.collect()} == brute(texts)
    # with min_block=1 every repeated line goes
    every = {r.id: len(r.spans) for r in d.repeated_spans(table, min_block=1).collect()}
    assert every[9] == 2


def test_borders_inside_one_text(spark, prose):
    words = prose[0].lower().rstrip(".").split()
    passage = " ".join(words[:15]) + ". " + " ".join(words[15:40]).capitalize() + ". " + " ".join(words[40:55]).capitalize()
    text = f"{prose[1][:-5]} {passage} one two. {prose[2][:-5]} {passage} three four."
    table = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    (found,) = d.repeated_spans(table).collect()
    assert [text[s:e] for s, e in found.spans] == [passage] and found.spans[0].start > 300


def test_two_texts_under_one_id(spark, prose):
    """Each row is cut by its own spans, and comes back once."""
    texts = [(1, prose[0]), (1, prose[1]), (2, prose[2]), (2, f"{prose[3]}\n{prose[0]}"), (3, f"{prose[0]}\n{prose[4]}"), (3, f"{prose[5]}\n{prose[1]}")]
    table = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = sorted((r.doc_id, r.text) for r in d.remove(table, d.repeated_spans(table)).collect())
    kept = [*texts[:3], (2, f"{prose[3]}\n"), (3, f"\n{prose[4]}"), (3, f"{prose[5]}\n")]
    assert found == sorted(kept)


def test_hot_line(spark, prose):
    """One line in a third of all documents, and one document many times."""
    line = prose[0].replace(" ", " b ")
    texts = [(i, f"{prose[i % 5 + 1]} number{i}\n{line if i % 3 == 0 else ''}") for i in range(300)]
    table = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert {r.id: [tuple(s) for s in r.spans] for r in d.repeated_spans(table).collect()} == brute(texts)


def test_edge_cases(messy, crowded, empty_docs):
    spans = d.repeated_spans(messy)
    assert spans.count() == messy.count()
    kept = d.remove(messy, spans)
    assert kept.count() == messy.count()
    by_id = {r.doc_id: r for r in kept.collect() if r.doc_id is not None}
    assert by_id[2].text is None and by_id[3].text == "" and by_id[1].removed_spans == []
    assert by_id[6].text == ""  # the words of document 1
    assert not re.search(r"\w", by_id[9].text)  # in document 5 already
    more = d.remove(crowded, d.repeated_spans(crowded))
    assert rows(more, "doc_id", "text", "removed_spans") == rows(kept, "doc_id", "text", "removed_spans")
    assert d.remove(empty_docs, d.repeated_spans(empty_docs)).count() == 0
