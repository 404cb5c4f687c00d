import pyarrow as pa
from pyspark.sql import functions as F

from carrel.sources.calls import CallLog, with_lots


def run(root, rows, called):
    """The outcomes of rows (hash, key), and how many outcomes were held at most."""
    log, got, held = CallLog(str(root), "step", pa.int64(), 10), [], 0

    def call(key):
        called.append(key)
        return int(key), None, 0

    for at, key in rows:
        log.turn_to(0, at)
        got.append(log.outcome(key, lambda: call(key))[0])
        held = max(held, len(log.known))
    log.close()
    return got, held


def test_a_lot_of_any_size_holds_few_outcomes(tmp_path):
    rows = [((i // 2 - 5_000) * 2**50, str(i // 2)) for i in range(20_000)]
    keys, called = [int(key) for _, key in rows], []
    got, held = run(tmp_path, rows, called)
    assert got == keys and held < 2_500 and len(called) == 10_000
    again, held = run(tmp_path, rows, called)
    assert again == keys and held < 2_500 and len(called) == 10_000


def test_rows_out_of_order_are_found_in_the_log(tmp_path):
    rows, called = [(i * 2**50, str(i)) for i in range(-500, 500)], []
    run(tmp_path, rows, called)
    assert run(tmp_path, rows[::-7], called)[0] == [int(key) for _, key in rows[::-7]] and len(called) == 1000


def test_rows_of_a_lot_come_by_hash(spark):
    rows = with_lots(spark.range(2000).selectExpr("cast(id % 900 as string) as id"), F.col("id"), 3)
    for part in rows.select("_lot", "_at", "_key").rdd.glom().collect():
        assert len({r["_lot"] for r in part}) == 1 and [r["_at"] for r in part] == sorted(r["_at"] for r in part)
