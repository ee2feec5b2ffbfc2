from telemill.functions import derive
from telemill.plans import suite
from telemill.session import new_folder
from telemill.sources import bindings as B, csv_tables as C


def test_suite_goes_on_without_the_machine_table(spark, sf_dir):
    folder, out = new_folder(spark, "data"), new_folder(spark, "out")
    telemetry = derive.time_parts(B.telemetry(spark, sf_dir)).select(*[c for c, _ in C.TELEMETRY_CSV])
    C.write_csv(telemetry, f"{folder}/telemetry.csv", C.TELEMETRY_NAMES)
    C.write_csv(B.status(spark, sf_dir), f"{folder}/status.csv", C.STATUS_NAMES)
    outcome = suite.run_suite(spark, folder, out)
    for name, result in outcome.items():
        if name.startswith("2."):
            assert "PATH_NOT_FOUND" in result
        else:
            assert result == "ok", (name, result)
    ranks = spark.read.option("header", True).csv(f"{out}/1.9_reliability_tiers")
    assert ranks.count() == B.telemetry(spark, sf_dir).select("device_id").distinct().count()
