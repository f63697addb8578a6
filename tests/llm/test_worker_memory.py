"""What a Python worker keeps between the tasks of different operators."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import jaccard, packing, pii
from shelfmark.llm.common import slices, trim
from shelfmark.llm.queries import pii_key, tokenizer_path


def test_caches_of_an_operator_go_when_another_works(spark):
    packing._encoder(tokenizer_path(spark), True)
    pii.surrogate("name", "schmidt", b"key")
    trim(packing._encoder)
    assert packing._encoder.cache_info().currsize == 1 and pii.surrogate.cache_info().currsize == 0
    trim()
    assert packing._encoder.cache_info().currsize == 0


def test_surrogates_need_no_rows_of_the_driver(spark, monkeypatch):
    docs = spark.range(2500).select(F.col("id").alias("doc_id"), F.concat(F.lit("Mr Smith, Herr Schmidt "), F.col("id").cast("string"), F.lit("@example.com")).alias("text"))
    made = spark.createDataFrame

    def arrow_only(data, *a, **b):
        assert isinstance(data, pa.Table)
        return made(data, *a, **b)

    monkeypatch.setattr(spark, "createDataFrame", arrow_only)
    out = pii.replace_pii(docs.coalesce(1), pii_key(spark), max_broadcast=10).orderBy("doc_id").collect()
    again = pii.replace_pii(docs.coalesce(1), pii_key(spark)).orderBy("doc_id").collect()
    assert len(out) == 2500 and out == again and all("Smith" not in r.text and r.n_entities == 3 for r in out)


@pytest.mark.parametrize("rows", [0, 1, 2500])
def test_record_batches_are_cut_and_whole(rows):
    batch = pa.record_batch({"a": pa.array(range(rows), pa.int64())})
    cut = list(slices([batch, batch]))
    assert [x for b in cut for x in b.column(0).to_pylist()] == 2 * list(range(rows)) and all(0 < b.num_rows <= 1000 for b in cut)


def test_passes_over_texts_hand_on_a_few_rows_at_a_time(spark):
    texts = spark.range(2500).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.lit(w) for w in "a b c d e f".split()], F.col("id").cast("string")).alias("text")).coalesce(1)
    sizes = []

    class Docs:
        schema = texts.schema

        def mapInArrow(self, run, fields):
            return list(run(iter(texts.toArrow().combine_chunks().to_batches())))

    for out in (jaccard.first_pass(Docs(), 5, 1 << 20), jaccard.prefixes(Docs(), 5, 80, bytes((1 << 20) // 8), 1 << 20)):
        sizes.append([b.num_rows for b in out if b.num_rows != jaccard.SLICES or len(out) < 4])
        ids = [i for b in out for i in b.column(0).to_pylist() if i is not None]
        assert sorted(ids) == list(range(2500))
    assert all(sum(s) >= 2500 and max(s) <= 1000 for s in sizes), sizes
