"""The language model in many shards: few files open at a time, and the same scores as in one."""

import os
import resource

import pyarrow as pa
from pyspark.sql import functions as F

from waymeter.llm import kneser_ney, shared
from waymeter.llm.queries import table
from waymeter.llm.shared import remainder

FOLDER = "/root/testdata/sf0.001"


def test_three_hundred_shards_under_256_descriptors(spark):
    docs = table(spark, FOLDER, "documents").select("doc_id", "text")
    one = {r.doc_id: r.score for r in kneser_ney.scored(docs.coalesce(1), remainder(F.col("doc_id"), 7) != 2).collect()}
    rows = docs.repartition(300)
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    model = kneser_ney.train(rows.where(remainder(F.col("doc_id"), 7) != 2).select("text"))
    assert len(model.words) == 512

    def maps():
        with open("/proc/self/maps") as lines:
            return sum("kneser-ney" in line for line in lines)

    def run(batches):
        before = maps()  # what the worker still has of the training
        soft, hard = resource.getrlimit(resource.RLIMIT_NOFILE)
        used = len(os.listdir("/proc/self/fd"))
        resource.setrlimit(resource.RLIMIT_NOFILE, (used + 256, hard))
        try:
            look = kneser_ney.Opened(model)
            for batch in batches:
                got = look.scores(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got["score"]), pa.array([maps() - before] * batch.num_rows)], ["doc_id", "score", "mapped"])
        finally:
            resource.setrlimit(resource.RLIMIT_NOFILE, (soft, hard))

    found = docs.select("doc_id", text).coalesce(2).mapInArrow(run, "doc_id long, score double, mapped long").collect()
    assert 100 < max(r.mapped for r in found) <= 160
    assert {r.doc_id: round(r.score, 6) for r in found} == {k: round(v, 6) for k, v in one.items()}


def test_the_arrays_used_last_stay_open(tmp_path):
    import numpy as np

    uris = [shared.store_array(f"file://{tmp_path}", f"a{k}", np.arange(k, k + 3, dtype="<u8")) for k in range(6)]
    held = shared.MappedArrays(limit=3)
    for k in (0, 1, 2, 0, 3, 4):
        assert held.get(uris[k], "<u8").tolist() == [k, k + 1, k + 2]
    assert list(held.open) == [uris[0], uris[3], uris[4]]
    first = held.get(uris[0], "<u8")
    assert held.get(uris[0], "<u8") is first and len(held.open) == 3
    assert held.get(uris[1], "<u8").tolist() == [1, 2, 3] and uris[3] not in held.open
