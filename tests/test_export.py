from telemill.plans import export, suite
from telemill.session import new_folder
from telemill.sources import bindings as B, csv_tables as C


def test_export_feeds_the_suite(spark, sf_dir):
    folder, out = new_folder(spark, "export"), new_folder(spark, "out")
    telemetry, snapshots = B.telemetry_base(spark, sf_dir), B.status_snapshots(spark, sf_dir).drop("user_id")
    paths = export.write_export(folder, telemetry, snapshots, B.fleet_events(spark, sf_dir), hours=48)
    devices = C.load_telemetry_csv(spark, paths["telemetry"]).select("device_id").distinct().count()
    assert spark.read.option("header", True).csv(paths["summary"]).count() == devices
    assert C.load_events_csv(spark, paths["events"]).count() > 0
    outcome = suite.run_suite(spark, folder, out, "fleet")
    assert set(outcome.values()) == {"ok"}, outcome
    assert spark.read.option("header", True).csv(f"{out}/1.2_per_device_summary").count() == devices


def test_empty_range_writes_nothing(spark, sf_dir):
    none = B.telemetry_base(spark, sf_dir).limit(0)
    assert export.write_export(new_folder(spark, "export"), none, B.status_snapshots(spark, sf_dir), B.fleet_events(spark, sf_dir)) == {}
