from pyspark.sql import functions as F

from ledgerloom.llm import common, packing
from ledgerloom.llm.queries import WORD_TOKENIZER


def test_texts_reach_python_in_batches_of_few_rows_and_memory_goes_back(spark):
    spark.conf.unset(common.RECORDS)
    docs = spark.range(2500).coalesce(1).select(F.col("id").alias("doc_id"), F.lit("a few words").alias("text"))

    def sizes(batches):
        yield from (b.select(["doc_id"]).slice(0, 1).set_column(0, "n", common.pa.array([b.num_rows])) for b in batches)

    found = [r["n"] for r in common.in_batches(docs, sizes, "n long").collect()]
    assert sum(found) == 2500 and max(found) <= common.BATCH_ROWS
    spark.conf.unset(common.RECORDS)
    assert packing.pack(docs, WORD_TOKENIZER).agg(F.sum("length")).first()[0] == 2500 * 4
    assert int(spark.conf.get(common.RECORDS)) == common.BATCH_ROWS
    # a smaller setting of the session holds
    spark.conf.set(common.RECORDS, "100")
    assert max(r["n"] for r in common.in_batches(docs, sizes, "n long").collect()) == 100
    spark.conf.unset(common.RECORDS)
    common.give_back()
