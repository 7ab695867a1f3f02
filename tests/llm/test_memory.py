import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riverlog.llm import common, op3_best_fit_packing as o3, op10_minhash_dedup as o10, tokens


class Frame:
    """Stands for a DataFrame; mapInArrow gives the function that workers would run."""

    def __init__(self, spark):
        self.sparkSession = spark

    def select(self, *columns):
        return self

    def mapInArrow(self, f, schema):
        return f


@pytest.fixture(autouse=True)
def nothing_kept():
    common.let_go()
    yield
    common.let_go()


def test_encoders_go_with_the_next_operator(spark):
    cut = o3.pieces_of(Frame(spark), tokens.default_vocabulary())
    texts = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2], pa.int64()), "text": ["one two", None]})
    rows = [r for b in cut(iter([texts])) for r in b.to_pylist()]
    first = tokens.encoder(tokens.default_vocabulary())
    again = [r for b in cut(iter([texts])) for r in b.to_pylist()]
    assert rows == again and len(rows) == 2
    assert tokens.encoder(tokens.default_vocabulary()) is first  # tasks of one owner share it
    assert list(common.map_arrow(Frame(spark), lambda batches: batches, "x long")(iter([texts]))) == [texts]
    assert not common.kept(tokens.OWNER)


def test_band_keys_come_in_small_batches(spark):
    rng = np.random.default_rng(1)
    sig = rng.integers(0, 1 << 32, (1000, o10.HASHES), dtype=np.uint32)
    classes = pa.RecordBatch.from_arrays([pa.array(np.arange(1000)), pa.array(np.arange(1000) + 7), pa.array([x.tobytes() for x in sig], pa.binary())], ["rep", "n", "sig"])
    spell = o10._keys(Frame(spark))
    got = list(spell(iter([classes, classes.slice(0, 0)])))
    assert max(b.num_rows for b in got) <= 256 * len(o10._PLACES)
    one = [b for i in range(1000) for b in spell(iter([classes.slice(i, 1)]))]
    assert pa.Table.from_batches(got) == pa.Table.from_batches(one).combine_chunks()
    assert sum(b.num_rows for b in got) == 1000 * len(o10._PLACES)


def test_split_reads_small_parts(spark):
    most = lambda df: df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    t = common.stored(spark.range(1_000_000).coalesce(1).select(F.xxhash64("id")), "numbers", group=1 << 19)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with common.split(spark, 1 << 19):
        assert most(t) <= 200_000
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert t.count() == 1_000_000
