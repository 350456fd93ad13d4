import ctypes
from pathlib import Path

import pyarrow as pa
import pytest

from llm_shared import docs  # noqa: F401
from starloom.llm import jaccard, packing, quality, tables

BATCH, READ = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize"


def resident():
    return int(Path("/proc/self/statm").read_text().split()[1]) * 4096


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="the allocator is not glibc's")
def test_a_task_gives_back_what_it_has_freed():
    held, pins = [], []

    def run(batches):
        for batch in batches:
            some = [bytes(1_500) for _ in range(60_000)]
            # what lives longer lies behind what is freed, so that the heap's end stays where it is
            pins.append([bytes(1_500) for _ in range(3)])
            held.append(resident())
            del some
            yield batch

    one = pa.RecordBatch.from_arrays([pa.array([1])], ["n"])
    assert [b.num_rows for b in tables.tidy(run)(iter([one]))] == [1]
    assert held[0] - resident() > 50e6


def pack(frame):
    packing.pieces(frame, "no tokenizer is read yet")


@pytest.mark.parametrize("work", [pack, quality.keep, jaccard.keep_one], ids=["pack", "keep", "keep_one"])
def test_what_is_read_and_sent_at_once_is_bounded(spark, docs, work):
    before = {k: spark.conf.get(k, None) for k in (BATCH, READ)}
    frame = docs((1, "some text of a few words"), (2, None))
    try:
        for k in before:
            spark.conf.unset(k)
        work(frame)
        assert spark.conf.get(BATCH) == str(tables.BATCH_BYTES) and spark.conf.get(READ) == str(tables.READ_ROWS)
        spark.conf.set(BATCH, "100m")
        spark.conf.set(READ, "77")
        work(frame)
        assert (spark.conf.get(BATCH), spark.conf.get(READ)) == ("100m", "77")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)
