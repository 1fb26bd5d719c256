"""The commands end to end: ingest files, build marts, check them, write the page."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from tests.small_tables import tables
from tidemark.__main__ import main
from tidemark.operators import capture
from tidemark.operators.quality import CheckFailed
from tidemark.plans import dashboard
from tidemark.schemas import ENTITIES
from tidemark.sources.changes import kafka_stream


def test_commands(spark, tmp_path, capsys):
    source = tables(spark)
    landed, store, built, out = (str(tmp_path / n) for n in ("in", "store", "marts", "page"))
    for name, entity in ENTITIES.items():
        capture.snapshot_events(getattr(source, name), entity, "shop.public").write.mode("append").parquet(landed)
    main(["ingest", store, "--checkpoint", f"{store}/checkpoint", "--files", landed])
    main(["build", store, built])
    with pytest.raises(CheckFailed, match="not_null_revenue_by_city_city"):
        main(["check", built])
    main(["page", store, out, "--city", "city0", "city1", "--start", "2024-03-10"])
    written = spark.read.parquet(f"{out}/cities")
    assert 0 < written.count() <= 2
    main(["page", store, out, "--status"])
    assert spark.read.parquet(f"{out}/cities").count() == 0
    mix = {tuple(r) for r in spark.read.parquet(f"{out}/payments").collect()}
    assert mix == {tuple(r) for r in dashboard.payment_mix(source).collect()}
    main(["latest", store, "-k", "5"])
    assert "event_ts" in capsys.readouterr().out


def test_kafka_source_needs_its_package(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        kafka_stream(spark, "localhost:9092", ["a"])
