"""Build the six monthly feature tables of one run (training or scoring).

Each source is placed on its own calendar (``source_months``: one scan of the
date column returning the distinct months, a calendar-bounded set), then the
window bounds become literal range predicates on EVT_DT that reach the
Parquet scan. Passing ``months`` pins every source to one common calendar.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.calendar import SourceMonths, source_months, sources_months
from ..operators import features as fx
from ..sources import fixtures


@dataclass
class FeatureTables:
    internet: DataFrame
    tv: DataFrame
    mobile: DataFrame
    socio: DataFrame
    journeys: DataFrame
    requests: DataFrame | None

    def as_dict(self) -> dict[str, DataFrame]:
        return dict(internet=self.internet, tv=self.tv, mobile=self.mobile, socio=self.socio,
                    journeys=self.journeys, requests=self.requests)


def fixture_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: fn(spark, sf_dir) for name, fn in fixtures.EVENT_SOURCES.items()}


def _months(df: DataFrame, months: SourceMonths | None) -> SourceMonths:
    return months if months is not None else source_months(df)


def internet_table(raw: DataFrame, mode: str, months: SourceMonths | None = None) -> DataFrame:
    return fx.usage_features(raw, fx.INTERNET, fx.l3m_window(_months(raw, months), mode))


def tv_table(raw: DataFrame, mode: str, months: SourceMonths | None = None) -> DataFrame:
    return fx.usage_features(raw, fx.TV, fx.l3m_window(_months(raw, months), mode))


def usage_tables(sources: dict[str, DataFrame], mode: str,
                 cal: dict[str, SourceMonths] | None = None) -> tuple[DataFrame, DataFrame]:
    """Internet and TV feature tables from one shared ranking pass."""
    cal = cal or sources_months({n: sources[n] for n in ("internet", "tv")})
    internet, tv = fx.usage_features_many([
        (sources["internet"], fx.INTERNET, fx.l3m_window(cal["internet"], mode)),
        (sources["tv"], fx.TV, fx.l3m_window(cal["tv"], mode))])
    return internet, tv


def journeys_table(raw: DataFrame, mode: str, months: SourceMonths | None = None) -> DataFrame:
    return fx.journey_features(raw, fx.l3m_window(_months(raw, months), mode))


def mobile_table(raw: DataFrame, mode: str, months: SourceMonths | None = None) -> DataFrame:
    return fx.mobile_features(raw, fx.l3m_window(_months(raw, months), mode))


def socio_table(raw: DataFrame, mode: str, months: SourceMonths | None = None) -> DataFrame:
    return fx.socio_features(raw, fx.all_months_window(_months(raw, months), mode))


def requests_table(raw: DataFrame, mode: str, months: SourceMonths | None = None) -> DataFrame:
    return fx.request_months(raw, fx.all_months_window(_months(raw, months), mode))


def build_feature_tables(sources: dict[str, DataFrame], mode: str,
                         months: SourceMonths | None = None,
                         with_requests: bool = True, dedupe: bool = False) -> FeatureTables:
    """All feature tables of one run. Without a common calendar, each
    source keeps its own (as the reference), found for all sources in one
    job. ``dedupe`` drops exact duplicate events first (H1)."""
    names = ["internet", "tv", "mobile", "socio_demo", "journeys"] + (["requests"] if with_requests else [])
    if dedupe:
        sources = {n: fx.dedupe_events(df) if n in names else df for n, df in sources.items()}
    if months is None:
        cal = sources_months({n: sources[n] for n in names})
    else:
        cal = {n: months for n in names}
    internet, tv = usage_tables(sources, mode, cal)
    return FeatureTables(
        internet=internet,
        tv=tv,
        mobile=mobile_table(sources["mobile"], mode, cal["mobile"]),
        socio=socio_table(sources["socio_demo"], mode, cal["socio_demo"]),
        journeys=journeys_table(sources["journeys"], mode, cal["journeys"]),
        requests=requests_table(sources["requests"], mode, cal["requests"]) if with_requests else None,
    )
