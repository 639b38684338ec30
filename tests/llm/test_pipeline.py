"""Each stage of the pipeline against plain loops over what its predecessor kept."""

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as pipeline
from kerbside.llm.bpe import load_ranks
from kerbside.llm.quality import classify
from . import test_decontaminate, test_simhash, test_suffix_dedup

SF_DIR = "/root/testdata/sf0.001"
FUNCTIONS = dict(pipeline.STAGES)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def kept(spark):
    """The documents before each stage, and the result."""
    out = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for _, stage in pipeline.STAGES:
        out.append(stage(spark, out[-1], SF_DIR).cache())
    return out


def test_columns_stay(kept):
    assert len(pipeline.STAGES) == 5
    for stage in kept[1:-1]:
        assert stage.dtypes == kept[0].dtypes


def test_quality(spark, kept):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    good = {r.doc_id for r in classify(kept[0], labels).where("predicted = 1").collect()}
    assert rows_of(kept[1]) == [r for r in rows_of(kept[0]) if r[0] in good]
    assert 0 < len(good) < kept[0].count()


def test_near_duplicates(kept):
    rows = kept[1].collect()
    prints = {r.doc_id: test_simhash.plain_print(r.text) for r in rows}
    roots = test_simhash.plain_roots(test_simhash.near(set(prints.values()), 4), set(prints.values()))
    first = {}
    for doc in sorted(prints):
        first.setdefault(roots[prints[doc]], doc)
    assert rows_of(kept[2]) == sorted((tuple(r) for r in rows if r.doc_id in first.values()), key=str)


def test_repeated_passages(kept):
    rows = kept[2].collect()
    digests = {r.doc_id: d for r, (*_, d) in zip(rows, test_suffix_dedup.plain([r.text for r in rows], 200), strict=True)}
    found = {r.doc_id: r for r in kept[3].collect()}
    assert found.keys() == digests.keys()
    for r in rows:
        kept_row = found[r.doc_id]
        assert (kept_row.lang, kept_row.source, kept_row.n_chars) == (r.lang, r.source, len(kept_row.text))
        if digests[r.doc_id] == test_suffix_dedup.hashlib.sha256(r.text.encode()).hexdigest():
            assert kept_row.text == r.text


def test_benchmark_leaks(spark, kept):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = [r for r in kept[3].collect() if not test_decontaminate.plain(r.text, items, 10)[4]]
    assert rows_of(kept[4]) == sorted(map(tuple, clean), key=str)


def test_encoding(kept):
    ranks = {token: rank for rank, token in enumerate(load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = {r.doc_id: list(r.ids) for r in kept[5].collect()}
    assert ids == {r.doc_id: library.encode_ordinary(r.text) for r in kept[4].collect()}


def test_run_is_all_stages(spark, kept):
    assert rows_of(pipeline.run(spark, SF_DIR)) == rows_of(kept[5])


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, n_chars int, row string, th int"
    rows = [(1, "same", "a", 4, "x", 1), (1, "same", "a", 4, "x", 1), (1, "other", "a", 5, "x", 1), (None, None, None, None, None, None), (2, "", "b", 0, "y", 2)]
    rows += [(None, "z " * 400, "c", 800, "w", 3), (7, "é" * 250, "c", 250, "w", 3), (8, "q" + "é" * 150, "c", 151, "w", 3)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in pipeline.STAGES:
        found = stage(spark, docs, SF_DIR)
        empty = stage(spark, docs.limit(0), SF_DIR)
        assert empty.count() == 0, name
        if name == "byte-level bpe":
            assert found.count() == len(rows)
        else:
            assert found.dtypes == docs.dtypes, name
    one = FUNCTIONS["simhash near-dedup"](spark, docs, SF_DIR).collect()
    assert sorted(str((r.doc_id, r.text)) for r in one)[:1] == ["(1, 'other')"]
    assert sum(r.text == "same" for r in one) == 1 and sum(not r.text for r in one) == 1
    cut = {(r.doc_id, r.lang): r.text for r in FUNCTIONS["suffix-array dedup"](spark, docs, SF_DIR).collect()}
    assert cut[None, None] is None and cut[7, "c"] == "" and cut[8, "c"] == "q"
