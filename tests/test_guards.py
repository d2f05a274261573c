"""Sources, publication and refusals."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from epochal.operators import scoring, split
from epochal.sources import schemas, tables


def test_declared_schemas_read_files_by_position(spark, tmp_path):
    names = {"conditions": "START,STOP,PATIENT,ENCOUNTER,SYSTEM,CODE,DESCRIPTION\n2001-02-03,,p1,e1,s,44,text\n", "payers": ",".join(schemas.SCHEMAS["payers"].names) + "\n"}
    for name, text in names.items():
        (tmp_path / f"{name}.csv").write_text(text)
    chosen = {n: schemas.SCHEMAS[n] for n in names}
    found = tables.load_tables(spark, str(tmp_path), chosen, {"conditions"})
    row = found["conditions"].first()
    assert (str(row["START"]), row["STOP"], row["CODE"]) == ("2001-02-03", None, "44") and len(schemas.SCHEMAS) == 10
    with pytest.raises(ValueError, match="payers is empty"):
        tables.load_tables(spark, str(tmp_path), chosen, {"payers"})
    with pytest.raises(FileNotFoundError):
        tables.load_tables(spark, str(tmp_path), {"patients": schemas.SCHEMAS["patients"]}, set())


def test_a_failed_audit_leaves_what_is_served(spark, tmp_path):
    root = f"file://{tmp_path}/served"
    one, two = spark.range(10), spark.range(20)
    assert tables.publish(one, root, True, ("id",)) and not tables.publish(two, root, False, ("id",))
    got, n = tables.served(spark, root)
    assert (got.count(), n) == (10, 1)
    assert tables.publish(two, root, True, ("id",))
    assert tables.served(spark, root)[0].count() == 20
    newest = spark.read.parquet(f"{root}/markers").orderBy(F.desc("at")).first()["path"]
    spark.range(1).write.mode("append").parquet(newest)  # someone else's rows
    with pytest.raises(ValueError, match="differs from its marker"):
        tables.served(spark, root)


def test_missing_labels_and_label_columns_are_refused(spark):
    rows = spark.createDataFrame([(1,), (2,)], "k long")
    labels = spark.createDataFrame([(1, 0)], "k long, y int")
    assert scoring.with_labels(rows.where("k = 1"), labels, "k", "y").first()["y"] == 0
    with pytest.raises(Exception, match="no label for 2"):
        scoring.with_labels(rows, labels, "k", "y").collect()
    dirty = rows.withColumn("label_horizon", F.lit(1))
    with pytest.raises(ValueError, match="label_horizon"):
        scoring.require_label_free(dirty)
    assert scoring.require_label_free(scoring.label_free(dirty)).columns == ["k"]


def test_windows_past_the_horizon(spark):
    end = F.lit("2001-07-01").cast("timestamp_ntz")
    stops = spark.createDataFrame([(datetime(2001, 6, 1),), (datetime(2001, 6, 1, 1),)], "stop timestamp_ntz")
    assert stops.where("hour(stop) = 0").select(scoring.require_observable(F.col("stop"), end).alias("s")).first()["s"] == datetime(2001, 6, 1)
    with pytest.raises(Exception, match="past the observation horizon"):
        stops.select(scoring.require_observable(F.col("stop"), end).alias("s")).collect()


def test_held_out_window_refusals(spark):
    def gate(*rows):
        frame = spark.createDataFrame([(i, p, datetime(2001, 1, d)) for i, p, d in rows], "encounter_id long, partition string, index_stop timestamp_ntz")
        return split.held_out_window(frame, F.lit("2001-01-01").cast("timestamp_ntz"), F.lit("2001-01-08").cast("timestamp_ntz"))[1]

    scoring.require_held_out(gate((1, "test", 2), (2, "train", 9)))
    for rows, message in ((((1, "train", 2),), "n_train = 1"), (((1, "censored", 2),), "n_unassigned = 1"), (((1, "test", 2), (1, "test", 3)), "n_duplicate = 1"), (((1, "test", 20),), "empty")):
        with pytest.raises(ValueError, match=message):
            scoring.require_held_out(gate(*rows))
