"""Reading the source tables.

The reports take their inputs as two small bundles of DataFrames, one per
transport system. They can come from a catalog (``spark.table``), from
Parquet folders with the declared schemas, or from any DataFrames the caller
builds (the stand-ins in :mod:`dockmart.sources.standin`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from dockmart.sources import schemas


@dataclass(frozen=True)
class Tables3G:
    load: DataFrame
    stop: DataFrame
    loc: DataFrame
    partner: DataFrame
    mode: DataFrame
    load_client: DataFrame
    load_order: DataFrame | None = None
    order_header: DataFrame | None = None
    order_leg: DataFrame | None = None
    order_leg_load: DataFrame | None = None


@dataclass(frozen=True)
class TablesALMS:
    loads: DataFrame
    legs: DataFrame
    stops: DataFrame
    locations: DataFrame


_3G_FIELDS = {
    "load": "Load",
    "stop": "Stop",
    "loc": "Loc",
    "partner": "TradingPartner",
    "mode": "TransportMode",
    "load_client": "Vw3g_Load_ClientAndCount",
    "load_order": "Vw3g_Load_Ord",
    "order_header": "OrdHeader",
}
#: Read on request only: no report needs them.
_ORDER_LEG_FIELDS = {"order_header": "OrdHeader", "order_leg": "OrdLeg", "order_leg_load": "OrdLeg_LoadLeg"}
_ALMS_FIELDS = {
    "loads": "METRIX_LOAD_hourly_2306",
    "legs": "METRIX_LOAD_LEG_hourly_2306",
    "stops": "METRIX_LOAD_LEG_STOP_Hourly_2306",
    "locations": "METRIX_LOCATION",
}


def _read_parquet(spark: SparkSession, root: str, name: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}")


def parquet_3g(spark: SparkSession, root: str, order_legs: bool = False) -> Tables3G:
    """3G tables stored as ``<root>/<TableName>/`` Parquet folders; with ``order_legs`` the order legs and their loads too."""
    known = schemas.TABLES_3G | (schemas.ORDER_LEG_TABLES_3G if order_legs else {})
    fields = _3G_FIELDS | (_ORDER_LEG_FIELDS if order_legs else {})
    return Tables3G(**{f: _read_parquet(spark, root, t, known[t]) for f, t in fields.items()})


def parquet_alms(spark: SparkSession, root: str) -> TablesALMS:
    """ALMS tables stored as ``<root>/<TableName>/`` Parquet folders."""
    return TablesALMS(**{f: _read_parquet(spark, root, t, schemas.TABLES_ALMS[t]) for f, t in _ALMS_FIELDS.items()})


def catalog_3g(spark: SparkSession, database: str | None = None, order_legs: bool = False) -> Tables3G:
    """3G tables from a catalog database (the source's ``USE <db>``)."""
    prefix = f"{database}." if database else ""
    fields = _3G_FIELDS | (_ORDER_LEG_FIELDS if order_legs else {})
    return Tables3G(**{f: spark.table(prefix + t) for f, t in fields.items()})


def catalog_alms(spark: SparkSession, database: str | None = None) -> TablesALMS:
    """ALMS tables from a catalog database."""
    prefix = f"{database}." if database else ""
    return TablesALMS(**{f: spark.table(prefix + t) for f, t in _ALMS_FIELDS.items()})


def write_tables(tables: Tables3G | TablesALMS, root: str, mode: str = "overwrite") -> None:
    """Write a bundle as ``<root>/<TableName>/`` Parquet folders."""
    fields = _3G_FIELDS | _ORDER_LEG_FIELDS if isinstance(tables, Tables3G) else _ALMS_FIELDS
    for f, t in fields.items():
        df = getattr(tables, f)
        if df is not None:
            df.write.mode(mode).parquet(f"{root.rstrip('/')}/{t}")


#: What the tables are joined and grouped by most.
_BUCKET_KEYS = {"stops": "Loadleg_ID", "legs": "Loadleg_Id", "loads": "Load_ID", "stop": "LoadId", "load": "LoadId", "load_client": "LoadId"}


def save_catalog(tables: Tables3G | TablesALMS, database: str, location: str, buckets: int) -> None:
    """Save a bundle as tables of a catalog database under ``location``, the large ones bucketed and sorted by their key.

    Joins and groupings of stops by leg (or load) then need no exchange of
    the stop table. ``buckets``: about the stop table's size over 256 MB, and
    at least the cluster's cores. Each task puts the rows it reads into its
    own files, one a bucket: dealing them by key first would be an exchange
    of all columns of the whole tables, for fewer files.
    """
    fields = _3G_FIELDS | _ORDER_LEG_FIELDS if isinstance(tables, Tables3G) else _ALMS_FIELDS
    for f, t in fields.items():
        df = getattr(tables, f)
        if df is None:
            continue
        writer = df.write.mode("overwrite").option("path", f"{location.rstrip('/')}/{t}")
        if f in _BUCKET_KEYS:
            writer = writer.bucketBy(buckets, _BUCKET_KEYS[f]).sortBy(_BUCKET_KEYS[f])
        writer.saveAsTable(f"{database}.{t}")
