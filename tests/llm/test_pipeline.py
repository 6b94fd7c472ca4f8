import collections
import random
import re
import shutil

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from cdclake.llm import bpe, ngram_jaccard, pfair_mix, quality_rules, secret_scan
from cdclake.llm.queries import ORACLES, QUERIES, VOCABULARY
from tests.llm.conftest import DOCUMENT, rows
from tests.llm.test_ngram_jaccard import brute as brute_classes
from tests.llm.test_secret_scan import brute as brute_spans


def test_names():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
    import __spark_entry__ as entry

    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(6)
    stems = ["".join(rng.choice("aeioulmnrst") for _ in range(5)) for _ in range(400)]
    docs, labels = [], []
    for i in range(500):
        words = [rng.choice(stems) for _ in range(90)]
        text = " ".join(words)
        if i % 5 == 0:
            text = " ".join(w + "%%%" for w in words)
        elif i % 11 == 0 and i > 20:
            text = docs[i - 10][1] if not i % 2 else docs[i - 10][1] + " tail"
        elif i % 13 == 0:
            text += " password = hunter2hunter2"
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(i % 5 != 0), 0))
    docs += [(900, None, None, None, None), (901, "", "en", "s1", 0), (902, "short text", "en", "s0", 10)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, DOCUMENT).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, docs


def test_stages_against_plain_computation(spark, corpus):
    path, docs = corpus
    now = spark.read.parquet(f"{path}/documents.parquet")
    results = {}
    for name, fn in pipeline.STAGES:
        now = fn(spark, now, path)
        results[name] = now.collect()
    columns = {n: list(r[0].asDict()) for n, r in results.items()}
    assert all(columns[n] == ["doc_id", "text", "lang", "source", "n_chars"] for n, _ in pipeline.STAGES[:-1])

    good = {i: t for i, t, *_ in docs if t and len(t.split()) >= 50 and "%%%" not in t}
    assert {r.doc_id: r.text for r in results["quality_rules"]} == good
    first = {c for _, c, _ in brute_classes(list(good.items())).values()}
    assert len(first) < len(good) and {r.doc_id: r.text for r in results["ngram_jaccard"]} == {i: good[i] for i in first}

    def masked(text):
        out, at = [], 0
        for start, _, end, _ in brute_spans(text):
            if start >= at:
                out += [text[at:start], "[SECRET]"]
            at = max(at, end)
        return "".join(out) + text[at:]

    clean = {i: masked(good[i]) for i in first}
    assert {r.doc_id: r.text for r in results["secret_scan"]} == clean and any("[SECRET]" in t for t in clean.values())
    assert all(r.n_chars == len(r.text) for r in results["secret_scan"])
    assert {r.doc_id: r.text for r in results["pfair_mix"]} == clean
    with open(VOCABULARY, encoding="utf-8") as f:
        own = bpe.Bpe(f.read())
    assert {r.doc_id: r.ids for r in results["bpe_encoding"]} == {i: own.encode(t) for i, t in clean.items()}
    # the mix is the order of the files
    sources = collections.Counter(r.source for r in results["pfair_mix"][: 3 * pfair_mix.BLOCK_ROWS])
    assert set(sources.values()) == {pfair_mix.BLOCK_ROWS}
    assert sorted(r.doc_id for r in pipeline.run(spark, path).collect()) == sorted(clean)


def test_the_result_is_in_the_order_of_the_mix(spark, corpus, tmp_path):
    path, docs = corpus
    result = pipeline.run(spark, path)
    source = {i: s for i, _, _, s, _ in docs}
    found = result.orderBy("mix_position").collect()
    assert [r.mix_position for r in found] == list(range(len(found)))
    table = spark.createDataFrame([(r.doc_id, source[r.doc_id]) for r in found], "doc_id bigint, source string")
    mixed = sorted(pfair_mix.mix(table).collect(), key=lambda r: (r.mix_slot, r.mix_offset))
    assert [r.doc_id for r in found] == [r.doc_id for r in mixed] != sorted(source)[: len(found)]
    # the files too
    files = result.select("_metadata.file_name", "mix_position").groupBy("file_name").agg(F.sort_array(F.collect_list("mix_position")).alias("at"))
    written = [r.at for r in files.orderBy("file_name").collect()]
    assert len(written) > 1 and sum(written, []) == list(range(len(found)))


def test_positions_follow_the_files_not_their_sizes(spark, tmp_path):
    sizes = [3, 50, 1, 20, 7]  # read again, the largest file would come first
    for k, n in enumerate(sizes):
        rows_ = [(sum(sizes[:k]) + i, "word " * n) for i in range(n)]
        part = spark.createDataFrame(rows_, "doc_id bigint, text string").coalesce(1)
        part.write.parquet(str(tmp_path / f"one{k}"))
        (file,) = (tmp_path / f"one{k}").glob("part-*.parquet")
        (tmp_path / "all").mkdir(exist_ok=True)
        shutil.copy(file, tmp_path / "all" / f"part-{k + 99998:05d}-x-c000.parquet")  # six digits from the third on
    out = pipeline.encoding_stage(spark, spark.read.parquet(str(tmp_path / "all")), "")
    assert [(r.doc_id, r.mix_position) for r in out.collect()] == [(i, i) for i in range(sum(sizes))]


def test_every_stage_takes_odd_rows(spark, corpus, messy, crowded, empty_docs):
    path, _ = corpus
    for name, fn in pipeline.STAGES:
        for docs in (messy, crowded, empty_docs):
            out = fn(spark, docs, path)
            out.collect()
            if name != "bpe_encoding":
                assert out.columns == docs.columns, name
        assert fn(spark, empty_docs, path).count() == 0


def test_each_stage_calls_its_operator(monkeypatch, spark, corpus):
    path, _ = corpus
    called = []
    for module, name in (
        (quality_rules, "keep_good"), (ngram_jaccard, "keep_first"), (secret_scan, "redact"), (pfair_mix, "in_order"), (bpe, "encode"),
    ):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, real=real, name=name, **b: called.append(name) or real(*a, **b))
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, fn in pipeline.STAGES:
        fn(spark, docs, path)
    assert called == ["keep_good", "keep_first", "redact", "in_order", "encode"]
    assert rows(docs.limit(0)) == []
