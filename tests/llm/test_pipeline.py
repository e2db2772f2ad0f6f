"""Each stage of the pipeline against a plain version, on what the stage before kept."""
import duckdb

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_operators import SF, check_packing, frame


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark, tmp_path):
    items = [x for (x,) in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9000, None, None, None, None), (9001, "", "en", "x", 0), (9002, "12 ?! 34", "en", "x", 8), (9003, "clean words in a row", None, None, None)], docs.schema)
    docs = docs.unionByName(extra)
    columns, before = docs.columns, sorted(pairs(docs), key=str)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k == 4:
            check_packing(out.collect(), before, 1023)
            break
        assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{name}.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{name}.parquet")
        after = pairs(docs)
        if k == 0:
            assert brute.multiset(after) == brute.multiset(x for x in before if any(map(str.isalpha, x[1] or "")))
        elif k == 1:
            want = {i: s for i, _, _, s in brute.lines(before)}
            assert {i: brute.sha(t) for i, t in after} == want and len(after) == len(before)
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        elif k == 2:
            stay = {i for i, _, c, _ in brute.jaccard(before) if i == c}
            assert {i for i, _ in after} == stay
        else:
            assert {i for i, _ in after} == {i for i, t in before if not any(x in t for x in items)}
        before = after


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_awkward_rows(spark):
    """Null ids and repeated rows pass all stages."""
    docs = frame(spark, [(None, "words without an id"), (1, "ein satz mit worten"), (1, "ein satz mit worten"), (2, None)]).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert sorted((r.doc_id or 0, r.text) for r in docs.collect()) == [(0, "words without an id"), (1, "ein satz mit worten"), (1, "ein satz mit worten")]


def test_empty_table_long_text_and_clashing_columns(spark):
    """An empty table stays one; a long text and columns named like the operators' own pass all stages."""
    names = "doc_id long, text string, lang string, source string, n_chars long, n long, c long, key string, kept string, carried string, queue string"
    long = " ".join(f"wort{i}" for i in range(60_000))
    rows = [(1, long, "de", "x", 5, 1, 2, "k", "kept", "carried", "q"), (2, "ein satz mit worten", "de", "y", 5, None, None, None, None, None, None)]
    for given in ([], rows):
        docs = spark.createDataFrame(given, names)
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == columns
        assert sorted((r.doc_id, r.text, r.kept, r.queue) for r in docs.collect()) == sorted((r[0], r[1], r[8], r[10]) for r in given)
        check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect(), [(r[0], r[1]) for r in given], 1023) if given else None
