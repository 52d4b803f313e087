import numpy as np
import pytest

from firmlens.llm import training_order as T


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(n):
    a, b = (T.permuted(np.arange(n), n, key) for key in (1, 2))
    assert sorted(a) == sorted(b) == list(range(n)) and (n < 16 or (a != b).any())


def ids(*tokens):
    return np.asarray(tokens, dtype="<u4").tobytes()


def test_shards(spark):
    r = np.random.default_rng(0)
    docs = [(k, ids(*r.integers(0, 50000, r.integers(0, 40)))) for k in range(100)] + [(100, None), (None, ids(7)), (5, ids(1, 2)), (5, ids(1, 2))]
    df = spark.createDataFrame([(i, b, "own", 1) for i, b in docs], "doc_id long, ids binary, slot string, shard int").repartition(5)
    shards = T.write_training_order(T.cut_sequences(df, length=8, end_id=9), key=3, length=8, pad_id=9, shard_rows=50)
    expected = []
    for i, b in docs:
        tokens = np.frombuffer(b or b"", dtype="<u4").tolist()
        tokens += [9] * bool(tokens)
        for k in range(0, len(tokens), 8):
            part = tokens[k : k + 8]
            expected.append((i, k // 8, len(part), tuple(part + [9] * (8 - len(part)))))
    rows = shards.read(spark).collect()
    got = [(r.doc_id, r.seq_no, r.n_tokens, tuple(np.frombuffer(r.tokens, dtype="<u2").tolist())) for r in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert sorted(r.slot for r in rows) == list(range(shards.sequences)) and all(r.shard == r.slot // 50 for r in rows)
    assert all(len(r.tokens) == shards.stride for r in rows)
    some = shards.read(spark, first=45, count=20)
    assert sorted(r.slot for r in some.collect()) == list(range(45, 65)) and {r.shard for r in some.collect()} == {0, 1}
    # a shard is one file in slot order
    one = spark.read.parquet(f"{shards.path}/shard=1")
    assert len(one.inputFiles()) == 1 and [r.slot for r in one.collect()] == list(range(50, 100))


def test_edges(spark):
    none = spark.createDataFrame([(1, None), (2, b"")], "doc_id long, ids binary")
    shards = T.write_training_order(T.cut_sequences(none, 8, 9), key=3, length=8, pad_id=9)
    assert shards.sequences == 0 and shards.read(spark).count() == 0
    wide = spark.createDataFrame([(1, ids(70_000))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="65,535"):
        T.cut_sequences(wide, 8, 9).collect()


def test_same_table_same_key_same_order(spark):
    df = spark.createDataFrame([(k, ids(k)) for k in range(200)], "doc_id long, ids binary").repartition(4, "doc_id")
    cut = T.cut_sequences(df, 4, 9)
    a, b, c = ({r.doc_id: r.slot for r in T.write_training_order(cut, key=k, length=4, pad_id=9).read(spark).collect()} for k in (1, 1, 2))
    assert a == b != c


def test_few_files_and_tasks_write_all_shards(spark, monkeypatch):
    monkeypatch.setattr(T, "MAX_FILES", 3)
    monkeypatch.setattr(T, "MAX_TASKS", 2)
    df = spark.createDataFrame([(k, ids(k)) for k in range(100)], "doc_id long, ids binary").repartition(7)
    shards = T.write_training_order(T.cut_sequences(df, 4, 9), key=3, length=4, pad_id=9, shard_rows=10)
    rows = shards.read(spark).collect()
    assert sorted(r.slot for r in rows) == list(range(100)) and sorted(r.doc_id for r in rows) == list(range(100))
    for k in range(10):
        one = spark.read.parquet(f"{shards.path}/shard={k}")
        assert len(one.inputFiles()) == 1 and [r.slot for r in one.collect()] == list(range(10 * k, 10 * k + 10))
