"""The daily batch when its driver dies, or when there are two of them."""

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas as SC
from shelfwise.plans import daily as DY
from shelfwise.sources import tables as TB
from shelfwise.sources import versions as V
from test_daily import moves_of, product, write


class Killed(BaseException):
    """Not an Exception: nothing can tidy up after it."""


def kill_at(monkeypatch, table):
    """The process dies when ``table`` is about to be published."""
    real = V.publish_file

    def publish(spark, path, text):
        if f"/{table}/_versions/" in path:
            raise Killed(table)
        return real(spark, path, text)
    monkeypatch.setattr(V, "publish_file", publish)


def tables_of(spark, lake):
    """The rows of fact, audit and moves, without surrogate keys."""
    out = {}
    for name, path, cols in (("fact", lake.fact, ["ingesta_date", "precio_regular"]),
                             ("audit", lake.audit, ["ingesta_date", "productid"]),
                             ("moves", lake.path("gold/price_moves"), ["productid", "fecha", "precio_actual"])):
        out[name] = sorted(tuple(map(str, r)) for r in TB.read_table(spark, path).select(*cols).collect())
    return out


def test_a_late_batch_killed_before_its_moves_are_there_loses_none(spark, scratch, monkeypatch):
    landing, lake = scratch("landing"), DY.Lake(scratch("lake"))
    write(landing, "2024-06-01", "a", [product("A", 10.0), product("B", 5.0)])
    write(landing, "2024-06-03", "a", [product("A", 12.0), product("B", 6.0)])
    DY.run_pending(spark, landing, lake)
    before = moves_of(spark, lake)
    assert [m[0] for m in before] == ["A", "B"]
    write(landing, "2024-06-02", "a", [product("A", 11.0)])
    with monkeypatch.context() as m:
        kill_at(m, "gold/price_moves")
        with pytest.raises(Killed):
            DY.run_daily_batch(spark, landing, lake, "2024-06-02", owner="me")
    assert moves_of(spark, lake) == before
    DY.run_daily_batch(spark, landing, lake, "2024-06-02", owner="me")
    from shelfwise.plans import analytics as A
    want = sorted(map(tuple, A.price_moves(TB.read_table(spark, lake.silver, SC.SILVER)).select(
        "productid", "fecha", "precio_anterior", "precio_actual").collect()))
    assert moves_of(spark, lake) == want and [(m[0], m[3]) for m in want] == [("A", 11.0), ("A", 12.0), ("B", 6.0)]


def test_killed_between_fact_and_audit(spark, scratch, monkeypatch):
    """A corrected batch: until a table is published its old rows are there."""
    landing, lake = scratch("landing"), DY.Lake(scratch("lake"))
    write(landing, "2024-06-01", "a", [product("A", 10.0), product("B", 5.0, labels=list("wxyz"))])
    DY.run_daily_batch(spark, landing, lake, "2024-06-01")
    before = tables_of(spark, lake)
    assert len(before["fact"]) == len(before["audit"]) == 1
    write(landing, "2024-06-01", "a", [product("A", 11.0), product("C", 5.0, labels=list("wxyz"))])
    for table in ("gold/fact", "gold/audit"):
        with monkeypatch.context() as m:
            kill_at(m, table)
            with pytest.raises(Killed):
                DY.run_daily_batch(spark, landing, lake, "2024-06-01", owner="me")
        now = tables_of(spark, lake)
        assert now["audit"] == before["audit"] and now["moves"] == before["moves"]
        assert (now["fact"] == before["fact"]) == (table == "gold/fact")
    DY.run_daily_batch(spark, landing, lake, "2024-06-01", owner="me")
    after = tables_of(spark, lake)
    assert ("2024-06-01", "11.0") in after["fact"] and ("2024-06-01", "C") in after["audit"]


def test_one_of_two_drivers_gets_the_batch(spark, scratch):
    lake, gate = DY.Lake(scratch("lake")), threading.Barrier(6)

    def claim(k):
        gate.wait()
        try:
            return DY.claim_batch(spark, lake, "2024-06-01", f"driver {k}")
        except DY.BatchClaimedError:
            return None
    with ThreadPoolExecutor(6) as pool:
        won = [w for w in pool.map(claim, range(6)) if w]
    assert len(won) == 1
    with pytest.raises(DY.BatchClaimedError):
        DY.claim_batch(spark, lake, "2024-06-01", "another")
    DY.release_batch(spark, won[0])
    mine = DY.claim_batch(spark, lake, "2024-06-01", "another", hours=2, clock=lambda: 1000.0)
    DY.claim_batch(spark, lake, "2024-06-01", "another", clock=lambda: 1001.0)  # its own batch
    with pytest.raises(DY.BatchClaimedError):
        DY.claim_batch(spark, lake, "2024-06-01", "third", clock=lambda: 1000.0 + 3600)
    assert DY.claim_batch(spark, lake, "2024-06-01", "third", clock=lambda: 1000.0 + 7 * 3600) != mine


def test_a_claimed_batch_is_left_alone_and_rejects_are_counted(spark, scratch):
    landing, lake = scratch("landing"), DY.Lake(scratch("lake"))
    odd = product("B", "free")
    odd["releaseDate"] = "soon"
    write(landing, "2024-06-01", "a", [product("A", "10.0"), odd, product("C", " ")])
    lease = DY.claim_batch(spark, lake, "2024-06-01", "another")
    with pytest.raises(DY.BatchClaimedError):
        DY.run_daily_batch(spark, landing, lake, "2024-06-01")
    assert DY.read_control(spark, lake) is None and not TB.table_exists(spark, lake.bronze)
    DY.release_batch(spark, lease)
    counts = DY.run_daily_batch(spark, landing, lake, "2024-06-01")
    assert counts == {"bronze": 3, "silver": 3, "fact": 3, "audit": 0}
    assert counts.rejects == {"precio_regular": 1, "precio_online": 1, "unit_multiplier": 0, "disponible": 0,
                              "cantidad_disponible": 0, "fecha_lanzamiento": 1}
    DY.vacuum(spark, lake, keep=1, older_than_hours=-1)
    assert TB.read_table(spark, lake.silver, SC.SILVER).filter(F.col("precio_regular") == 10.0).count() == 1
