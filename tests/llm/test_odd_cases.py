"""Every operator on null, empty, repeated and very long texts, empty tables, and clashing column names."""

import pytest
from pyspark.sql import functions as F

from lakemill.llm import (
    combination_join, latent_retrieval, license_join, piece_lattice, quality_rules, recurrent_lm, rendezvous,
    rule_ensemble, sentence_spans, separator_scan,
)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1), (4, 0), (None, 1), (6, 1), (99, 0)], "doc_id long, quality int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "a b c d e f g h i j k l."), (2, None), (3, "")], "item_id long, text string")


@pytest.fixture(scope="module")
def pieces():
    return piece_lattice.load_pieces()


def operators(spark, labels, benchmark, pieces):
    return {
        "separator scan": lambda d: separator_scan.token_counts(spark, d),
        "piece lattice": lambda d: piece_lattice.encoded(spark, d, pieces)[0],
        "recurrent lm": lambda d: recurrent_lm.scored(spark, d),
        "rendezvous": lambda d: rendezvous.sharded(d.select("doc_id", "text"), "doc_id", [1.0] * 3, [1.0] * 4),
        "rule ensemble": lambda d: rule_ensemble.scored(d, rule_ensemble.trained(d, labels))[0],
        "sentence spans": lambda d: sentence_spans.without_repeats(spark, d)[0],
        "license join": lambda d: license_join.scanned(spark, d),
        "latent retrieval": lambda d: latent_retrieval.searched(spark, d, benchmark)[0],
        "quality rules": lambda d: quality_rules.judged_documents(d, labels)[0],
        "combination join": lambda d: combination_join.near_duplicates(spark, d),
    }


NAMES = ["separator scan", "piece lattice", "recurrent lm", "rendezvous", "rule ensemble", "sentence spans", "license join",
         "latent retrieval", "quality rules", "combination join"]


@pytest.mark.parametrize("name", NAMES)
def test_each_row_gets_a_result(spark, odd, labels, benchmark, pieces, name):
    op = operators(spark, labels, benchmark, pieces)[name]
    out = op(odd)
    ids = lambda df: sorted((r[0] for r in df.select("doc_id").collect()), key=repr)
    assert ids(out) == ids(odd)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, docs_of, labels, benchmark, pieces, name):
    assert operators(spark, labels, benchmark, pieces)[name](docs_of([])).count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_extra_columns_with_clashing_names(spark, docs_of, labels, benchmark, pieces, name):
    docs = docs_of([(1, "one two three."), (2, "one two three.")]).withColumns({
        c: F.lit(7) for c in ("n", "key", "score", "qr_kept", "sd_removed", "sp_ids", "lr_hits", "re_score", "shard", "id", "row", "xxh")})
    out = operators(spark, labels, benchmark, pieces)[name](docs)
    assert out.count() == 2
    kept = [c for c in ("qr_kept", "sd_removed", "sp_ids", "lr_hits", "re_score") if c in out.columns]
    assert all(r[c] == 7 for r in out.select(*kept).collect() for c in kept)


def test_batches_are_taken_in_parts(spark):
    import pyarrow as pa

    from lakemill.llm.frames import in_parts

    batch = pa.RecordBatch.from_arrays([pa.array(range(1201))], names=["x"])
    parts = list(in_parts(iter([batch, batch.slice(0, 0)])))
    assert [p.num_rows for p in parts] == [500, 500, 201] and pa.Table.from_batches(parts).column(0).to_pylist() == list(range(1201))


def test_texts_go_to_python_once_and_not_back_for_calibration(spark, docs_of):
    from lakemill.llm.text_stats import with_counts

    docs = docs_of([(1, "one two"), (2, None)])
    plan = with_counts(docs, "t_")._jdf.queryExecution().optimizedPlan().toString()
    assert "as binary" not in plan
    slim = with_counts(docs, "t_", drop_text=True)
    assert "text" not in slim.columns and [r["t_n_words"] for r in slim.orderBy("doc_id").collect()] == [2, 0]
