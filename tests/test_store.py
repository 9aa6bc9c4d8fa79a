import tempfile

import pytest
from pyspark.sql import functions as F

from floorlens.sources import store
from floorlens.sources.schemas import TABLES
from tests.fixtures import make_floor, rows


def _floor(spark):
    return make_floor(
        spark, location=[{}], player=[{}, {"player_id": "P2"}], machine=[{}],
        session=[{"session_id": "A"}], transaction=[{"session_id": "A"}, {"session_id": "A", "transaction_timestamp": "2024-02-03 10:00:00"}],
        event=[{}],
    )


def test_csv_round_trip(spark):
    floor, folder = _floor(spark), tempfile.mkdtemp(prefix="floorlens-csv-")
    for table, (stem, _, _, _) in TABLES.items():
        store.write_output(getattr(floor, table), f"{folder}/{stem}.csv", "csv")
    back = store.floor_from_csv(spark, folder)
    for table, (_, schema, _, _) in TABLES.items():
        got = getattr(back, table)
        assert [f.dataType for f in got.schema] == [f.dataType for f in schema]
        assert sorted(map(str, rows(got))) == sorted(map(str, rows(getattr(floor, table))))


def test_csv_header_order_bad_values_and_missing_columns(spark):
    folder = tempfile.mkdtemp(prefix="floorlens-csv-")
    with open(f"{folder}/players.csv", "w") as f:
        f.write("active_flag,player_id,enrollment_date,loyalty_tier,age_band,home_region,marketing_opt_in\n"
                "1,P1,2024-01-05,Gold,21-30,R,True\n0,P2,not a date,Gold,21-30,R,0\n")
    one, two = sorted(rows(store.read_csv(spark, folder, "player")), key=lambda r: r["player_id"])
    assert (str(one["enrollment_date"]), one["marketing_opt_in"], one["active_flag"]) == ("2024-01-05", 1, 1)
    assert two["enrollment_date"] is None
    with open(f"{folder}/locations.csv", "w") as f:
        f.write("location_id\nL1\n")
    with pytest.raises(ValueError):
        store.read_csv(spark, folder, "location")


def test_warehouse_full_refresh_and_pruning(spark):
    floor, root = _floor(spark), tempfile.mkdtemp(prefix="floorlens-wh-")
    first = store.load_warehouse(floor, root)
    assert store.floor_from_warehouse(spark, root).transaction.count() == 2
    pruned = store.floor_from_warehouse(spark, root, first_month="2024-02-01")
    assert pruned.transaction.count() == 1 and pruned.player.count() == 2

    broken = make_floor(spark, location=[{}], player=[{}])
    bad = type(broken)(**{**broken.__dict__, "event": floor.event.withColumn("event_id", F.raise_error(F.lit("unreadable")))})
    with pytest.raises(Exception):
        store.load_warehouse(bad, root)
    assert store.current_version(spark, root) == first  # the failed load changed nothing
    assert store.floor_from_warehouse(spark, root).player.count() == 2
    assert store.load_warehouse(floor, root) == store.current_version(spark, root) != first


def test_views_and_exports(spark):
    floor, root = _floor(spark), tempfile.mkdtemp(prefix="floorlens-out-")
    names = store.register_views(floor)
    assert {"machine_daily", "machine_health", "feature_player_churn"} <= set(names)
    assert store.load_view(spark, "player_summary", "player_id").first()["player_id"] == "P1"
    paths = store.write_exports(floor, root)
    assert spark.read.parquet(paths["player_segments"]).count() == 1
    published = store.publish_views(floor, f"{root}/views")
    assert spark.read.parquet(published["v4_machine_health"]).count() == 1
