"""All registered queries by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from daytally.plans import batch, stream
from daytally.session import settings

Query = Callable[[SparkSession, str], DataFrame]

BATCH: dict[str, Query] = {
    "daily_pu_rev": batch.daily_pu_rev,
    "daily_pu_rev_approx": batch.daily_pu_rev_approx,
    "daily_category_product": batch.daily_category_product,
    "daily_address": batch.daily_address,
    "daily_address_approx": batch.daily_address_approx,
    "float32_sums": batch.float32_sums,
    "revenue_on_date": batch.revenue_on_date,
    "rollup_consistency": batch.rollup_consistency,
    "list_price": batch.list_price_query,
    "record_metrics": batch.record_metrics,
    "customer_dim": batch.customer_dim,
    "product_dim": batch.product_dim,
    "geocode_records": batch.geocode_records,
    "raw_upsert": batch.raw_upsert,
    "decode_records": batch.decode_records,
    "encode_records": batch.encode_records_query,
    "encode_changelog": batch.encode_changelog,
    "quarantine": batch.quarantine,
    "good_records": batch.good_records,
    "typed_reports": batch.typed_reports,
    "text_tables": batch.text_tables,
    "csv_scan": batch.csv_scan,
    "daily_export": batch.daily_export,
    "synth_records": batch.synth_records,
    "synth_records_scaled": batch.synth_records_scaled,
    "upsert_daily_pu_rev": batch.upsert_daily_pu_rev,
    "upsert_daily_category_product": batch.upsert_daily_category_product,
    "upsert_daily_address": batch.upsert_daily_address,
}

STREAM: dict[str, Query] = {
    "stream_raw": stream.stream_raw,
    "raw_folded": stream.raw_folded,
    "sql_records_of_day": stream.sql_records_of_day,
    "stream_daily_pu_rev": stream.stream_daily_pu_rev,
    "stream_daily_category_product": stream.stream_daily_category_product,
    "stream_daily_address": stream.stream_daily_address,
    "stream_late_rows": stream.stream_late_rows,
    "stream_daily_final": stream.stream_daily_final,
    "stream_restart": stream.stream_restart,
    "stream_fanout": stream.stream_fanout,
    "stream_quarantine": stream.stream_quarantine,
    "changelog_latest": stream.changelog_latest,
    "changelog_compacted": stream.changelog_compacted,
    "replay_idempotent": stream.replay_idempotent,
    "publish_run": stream.publish_run,
    "users_rolled_up": stream.users_rolled_up,
    "late_account": stream.late_account,
    "sql_daily_records": stream.sql_daily_records,
    "sql_quarantine": stream.sql_quarantine,
}


def _in_utc(query: Query) -> Query:
    """Event windows and text timestamps are in UTC, whatever the caller's zone. Plans
    take the zone as they are made, so the caller's comes back afterwards."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with settings(spark, {"spark.sql.session.timeZone": "UTC"}):
            return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _in_utc(query) for name, query in {**BATCH, **STREAM}.items()}
