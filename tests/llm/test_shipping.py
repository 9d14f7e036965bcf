"""Functions on workers."""
import pyarrow as pa

from martflow.llm import shipping


def test_a_task_gives_its_memory_back(monkeypatch):
    """At its end, also if its last batches are not asked for."""
    calls = []
    monkeypatch.setattr(shipping, "_release", lambda: calls.append(1))
    batches = [pa.RecordBatch.from_pylist([{"n": i}]) for i in range(3)]
    run = shipping.releasing(lambda it: (b for b in it))
    assert list(run(iter(batches))) == batches and len(calls) == 1
    some = run(iter(batches))
    next(some)
    some.close()
    assert len(calls) == 2


def test_mapped_rows_are_the_function_s(spark):
    rows = shipping.map_arrow(spark.range(100).repartition(3), lambda it: (b for b in it), "id bigint")
    assert sorted(r["id"] for r in rows.collect()) == list(range(100))
