"""The mart of ``snapshot_latest`` is made once for both snapshots."""

from tillmark.plans import marts
from tillmark.registry import queries

SF = "/root/testdata/sf0.001"


def test_both_snapshots_come_from_one_mart(spark, monkeypatch):
    published = []
    publish = queries.parquet.publish_snapshot

    def seen(df, root, mart, epoch_ms, **kind):
        published.append((epoch_ms, df._jdf.queryExecution().optimizedPlan().toString()))
        return publish(df, root, mart, epoch_ms, **kind)

    monkeypatch.setattr(queries.parquet, "publish_snapshot", seen)
    got = queries.QUERIES["snapshot_latest"](spark, SF)
    wanted = marts.customer_mart(*queries.star(spark, SF).parts)
    assert got.count() == wanted.count()
    assert sorted(epoch for epoch, _ in published) == [1_700_000_000_000, 1_700_000_001_000]
    assert sum("Join" in plan for _, plan in published) == 1
