import corpus_pipeline
import pytest

from tickloom.llm import registry
from tickloom.llm.common import written


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage at the smallest size."""
    sf = "/root/testdata/sf0.001"
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        got = written(stage(spark, docs, sf))
        out.append((name, docs, got))
        docs = got
    return {name: (a, b) for name, a, b in out}


def test_stages_are_in_order_and_keep_the_columns(stages):
    assert list(stages) == ["toxicity", "quality", "near_dedup", "suffix_dedup", "packing"]
    for name, (a, b) in stages.items():
        if name != "packing":
            assert b.schema.simpleString() == a.schema.simpleString()


def test_filters_drop_what_their_models_reject(spark, stages):
    from tickloom.llm import quality, toxicity

    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    for name, module, keep in (("toxicity", toxicity, 0), ("quality", quality, 1)):
        a, b = stages[name]
        want = {r["doc_id"] for r in module.classify(a, labels).collect() if r["predicted"] == keep}
        assert {r["doc_id"] for r in b.collect()} == want
        assert 0.5 * a.count() < b.count() <= a.count()


def test_one_document_of_each_class_stays(stages):
    from test_minhash import brute

    a, b = stages["near_dedup"]
    rows = sorted(a.select("doc_id", "text").collect())
    roots = brute([r["text"] for r in rows])
    assert {r["doc_id"] for r in b.collect()} == {rows[k]["doc_id"] for k in set(roots)}


def test_repeats_are_cut(stages):
    from test_suffix import brute

    a, b = stages["suffix_dedup"]
    rows = sorted(a.select("doc_id", "text").collect())
    want = brute([r["text"] for r in rows], corpus_pipeline.PASSAGE_BYTES)
    got = {r["doc_id"]: r for r in b.collect()}
    assert len(got) == len(rows)
    for r, (n, removed, spans, _) in zip(rows, want, strict=True):
        left = len(got[r["doc_id"]]["text"].encode())
        assert n - removed - 6 * spans <= left <= n - removed
        assert got[r["doc_id"]]["n_chars"] == len(got[r["doc_id"]]["text"])


def test_packed_pieces_hold_every_document(stages):
    from test_bpe_and_packing import check_places, ids_of

    a, b = stages["packing"]
    rows = b.collect()
    check_places(rows, 1024)
    total = {}
    for r in rows:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == {r["doc_id"]: len(ids_of(r["text"])) + 1 for r in a.collect()}


def test_run_equals_its_stages(spark, stages):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").select("doc_id", "piece", "length", "ids_crc32").exceptAll(stages["packing"][1].select("doc_id", "piece", "length", "ids_crc32")).isEmpty()


def test_ten_queries_are_registered():
    assert [n.split("_")[0] for n in registry.queries() if n.startswith("op")] == [f"op{k}" for k in range(1, 11)]
    assert set(registry.oracle_sql()) <= set(registry.queries())
