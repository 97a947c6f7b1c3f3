"""Event, transport and climate files as typed tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import COMPACT, iso_or_epoch, parse
from tidemark.functions.scalar import blank_to_null, lookup, to_double
from tidemark.sources.files import check_columns
from tidemark.sources.grids import Layout

# Layout and codes of the daily event export.
GDELT_COLUMNS = (
    "GlobalEventID", "SQLDATE", "MonthYear", "Year", "FractionDate",
    "Actor1Code", "Actor1Name", "Actor1CountryCode", "Actor1KnownGroupCode",
    "Actor1EthnicCode", "Actor1Religion1Code", "Actor1Religion2Code",
    "Actor1Type1Code", "Actor1Type2Code", "Actor1Type3Code",
    "Actor2Code", "Actor2Name", "Actor2CountryCode", "Actor2KnownGroupCode",
    "Actor2EthnicCode", "Actor2Religion1Code", "Actor2Religion2Code",
    "Actor2Type1Code", "Actor2Type2Code", "Actor2Type3Code",
    "IsRootEvent", "EventCode", "EventBaseCode", "EventRootCode", "QuadClass",
    "GoldsteinScale", "NumMentions", "NumSources", "NumArticles", "AvgTone",
    "Actor1Geo_Type", "Actor1Geo_FullName", "Actor1Geo_CountryCode",
    "Actor1Geo_ADM1Code", "Actor1Geo_Lat", "Actor1Geo_Long", "Actor1Geo_FeatureID",
    "Actor2Geo_Type", "Actor2Geo_FullName", "Actor2Geo_CountryCode",
    "Actor2Geo_ADM1Code", "Actor2Geo_Lat", "Actor2Geo_Long", "Actor2Geo_FeatureID",
    "ActionGeo_Type", "ActionGeo_FullName", "ActionGeo_CountryCode",
    "ActionGeo_ADM1Code", "ActionGeo_Lat", "ActionGeo_Long", "ActionGeo_FeatureID",
    "DATEADDED", "SOURCEURL",
)
ACTOR_COUNTRIES = ("IND", "IRN", "SAU", "ARE", "IRQ", "QAT", "KWT", "OMN", "YEM", "EGY", "ISR", "USA", "RUS", "CHN")
PLACE_COUNTRIES = ("IN", "IR", "SA", "AE", "IZ", "QA", "KU", "MU", "YM", "EG", "IS", "US", "RS", "CH")
CONFLICT_ROOTS = ("14", "15", "16", "17", "18", "19", "20")
QUAD_CLASS = {1: "verbal_cooperation", 2: "material_cooperation", 3: "verbal_conflict", 4: "material_conflict"}
# Positional fields of a state vector.
STATE_FIELDS = (
    "icao24", "callsign", "origin_country", "time_position", "last_contact",
    "longitude", "latitude", "baro_altitude", "on_ground", "velocity",
    "true_track", "vertical_rate", "sensors", "geo_altitude", "squawk",
    "spi", "position_source", "category",
)
STATE_NUMBERS = ("longitude", "latitude", "baro_altitude", "geo_altitude", "velocity", "true_track", "vertical_rate")
# Centre month of each three-month season; phase thresholds.
SEASON_CENTRE = {"DJF": 1, "JFM": 2, "FMA": 3, "MAM": 4, "AMJ": 5, "MJJ": 6, "JJA": 7, "JAS": 8, "ASO": 9, "SON": 10, "OND": 11, "NDJ": 12}
PHASE_LIMIT = 0.5
# Grid layout and regions (west, east, south, north).
GRID_LON, GRID_LAT, GRID_UNDEF = 720, 360, -999.0
REGIONS = {
    "all_india": (68.0, 97.5, 6.5, 37.5),
    "northwest": (69.0, 82.0, 23.0, 37.0),
    "central": (72.0, 87.0, 18.0, 26.0),
    "south_peninsula": (73.0, 81.0, 8.0, 18.0),
    "east_northeast": (85.0, 97.0, 21.0, 29.0),
}


def daily_events(lines: DataFrame, actors: Sequence[str] = ACTOR_COUNTRIES, places: Sequence[str] = PLACE_COUNTRIES, conflict_only: bool = False) -> DataFrame:
    """Headerless tab-separated events of a country universe.

    Actors and places use different country codes, so each is tested against its own set;
    a row is kept if any of the three matches. Two dates are kept under their own names.
    """
    ddl = ", ".join(f"{c} string" for c in GDELT_COLUMNS)
    rows = lines.where(F.size(F.split("line", "\t")) == len(GDELT_COLUMNS)).select(F.from_csv("line", ddl, {"sep": "\t", "quote": ""}).alias("r")).select("r.*")
    known = lambda c, s: F.coalesce(F.col(c).isin(*s), F.lit(False))
    rows = rows.where(known("Actor1CountryCode", actors) | known("Actor2CountryCode", actors) | known("ActionGeo_CountryCode", places))
    if conflict_only:
        rows = rows.where(F.col("EventRootCode").isin(*CONFLICT_ROOTS))
    floats, ints = ("GoldsteinScale", "AvgTone"), ("NumMentions", "NumSources", "NumArticles", "QuadClass")
    typed = [to_double(c).alias(c) if c in floats else F.col(c).try_cast("bigint").alias(c) if c in ints else F.col(c) for c in GDELT_COLUMNS]
    return rows.select(*typed).withColumn("event_date", parse("SQLDATE", COMPACT)).withColumn("ingested_date", parse("DATEADDED", COMPACT)) \
        .withColumn("quad_class_label", lookup({str(k): v for k, v in QUAD_CLASS.items()}, F.col("QuadClass").cast("string")))


ALERT = ("title: string, eventtype: string, alertlevel: string, severity: string, country: string, fromdate: string, todate: string, population: string, "
         "lat: string, long: string, pubDate: string, link: string")


def _alert_items(docs: DataFrame) -> tuple[DataFrame, Column]:
    """(path, _items) of each feed, and why a feed can't be read; null where it can."""
    x = F.from_xml("content", f"struct<channel: struct<item: array<struct<{ALERT}>>>>", {"ignoreNamespace": "true"})
    unnamed = ~F.exists("_items", lambda r: r["eventtype"].isNotNull()) & (F.size("_items") > 0)
    return docs.select("path", x["channel"]["item"].alias("_items")), F.when(unnamed, "no item has an event type; the names of the feed changed")


def disaster_alerts(docs: DataFrame, strict: bool = True) -> DataFrame:
    """Items of alert feeds with numeric positions.

    A feed none of whose items has an event type raises when it is read: its element names changed. Without ``strict`` its items
    are left out, and it is in ``alert_rejects``. A feed without items has no rows.
    """
    feeds, reason = _alert_items(docs)
    told = F.raise_error(F.concat("path", F.lit(": "), reason)).cast("boolean") if strict else F.lit(False)
    r = feeds.where(F.when(reason.isNull(), True).otherwise(told)).select("path", F.explode("_items").alias("r"))
    names = {"title": "title", "event_type": "eventtype", "alert_level": "alertlevel", "severity": "severity", "country": "country", "from_date": "fromdate",
             "to_date": "todate", "population": "population", "pub_date": "pubDate", "link": "link"}
    return r.select("path", *[F.trim(F.col(f"r.{s}")).alias(o) for o, s in names.items()], to_double("r.lat").alias("lat"), to_double("r.long").alias("lon"))


def alert_rejects(docs: DataFrame) -> DataFrame:
    """(path, reason) of the alert feeds that can't be read."""
    feeds, reason = _alert_items(docs)
    return feeds.select("path", reason.alias("reason")).where("reason IS NOT NULL")


def chokepoint_pages(docs: DataFrame, fields: Sequence[str], required: Sequence[str] = ("date", "portname", "n_total")) -> DataFrame:
    """Feature pages as rows. A page that carries an error inside a successful answer is an
    error; dates come as epoch milliseconds or ISO text."""
    check_columns(fields, required, "chokepoints")
    inner = ", ".join(f"`{f}`: string" for f in fields)
    d = docs.withColumn("_d", F.from_json("content", f"struct<error: struct<code: bigint, message: string>, features: array<struct<attributes: struct<{inner}>>>>"))
    bad = F.col("_d.error").isNotNull()
    d = d.where(F.when(bad, F.raise_error(F.concat(F.lit("page query failed: "), F.coalesce("_d.error.message", F.lit("?")))).cast("boolean")).otherwise(F.lit(True)))
    a = d.select(F.explode("_d.features").alias("f")).select("f.attributes.*")
    counts = [c for c in fields if c.startswith(("n_", "capacity"))]
    return a.select(*[to_double(c).alias(c) if c in counts else iso_or_epoch(c).alias(c) if c == "date" else F.col(c) for c in fields if c != "ObjectId"]) \
        .where("date IS NOT NULL")


def aircraft_states(docs: DataFrame) -> DataFrame:
    """Positional state vectors as named columns; a short vector reads NULL at its end.
    ``docs``: box, content."""
    d = F.from_json("content", "struct<time: bigint, states: array<array<string>>>")
    s = docs.select("box", d.alias("d")).select("box", F.timestamp_seconds("d.time").alias("snapshot_time"), F.explode("d.states").alias("s"))
    value = lambda i, f: to_double(F.get("s", F.lit(i))) if f in STATE_NUMBERS else blank_to_null(F.get("s", F.lit(i)))
    return s.select(*[value(i, f).alias(f) for i, f in enumerate(STATE_FIELDS)], "snapshot_time", "box")


def ocean_index(lines: DataFrame) -> DataFrame:
    """Whitespace-delimited index with a joinable centre month and a phase."""
    p = F.split(F.trim("line"), r"\s+")
    d = lines.select(p.alias("p")).where(F.size("p") == 4).select(F.col("p")[0].alias("season"), F.col("p")[1].try_cast("bigint").alias("year"),
                                                                   to_double(F.col("p")[2]).alias("sst_c"), to_double(F.col("p")[3]).alias("anomaly_c"))
    month = lookup(SEASON_CENTRE, "season")
    phase = F.when(F.col("anomaly_c") >= PHASE_LIMIT, "el_nino").when(F.col("anomaly_c") <= -PHASE_LIMIT, "la_nina").otherwise("neutral")
    return d.where("year IS NOT NULL AND anomaly_c IS NOT NULL").withColumn("centre_month", month).withColumn(
        "period", F.concat(F.col("year").cast("string"), F.lit("-"), F.lpad(F.col("centre_month").cast("string"), 2, "0"))).withColumn("phase", phase)


CELL_SCHEMA = "path string, layer int, lat double, lon double, value double"


def grid_cells(files: DataFrame, n_lon: int = GRID_LON, n_lat: int = GRID_LAT, layers: int = 2, lon0: float = 0.25, lat0: float = -89.75,
               step: float = 0.5, undef: float = GRID_UNDEF) -> DataFrame:
    """Cells of little-endian float32 grids, one row each, undefined cells left out.

    ``files``: path, content (binary). A file of another size raises: the product changed
    and reshaping it would scramble the geography. A grid has a fixed number of cells.
    """
    layout = Layout(n_lon, n_lat, layers, lon0, lat0, step, undef)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                for layer, lat, lon, value in layout.cells(content, path):
                    yield pd.DataFrame({"path": path, "layer": layer, "lat": lat, "lon": lon, "value": value})

    return files.select("path", "content").mapInPandas(decode, CELL_SCHEMA)


def regional_means(cells: DataFrame, regions: Mapping[str, tuple] = REGIONS, by: Sequence[str] = ("date",), value: str = "value") -> DataFrame:
    """Cosine-latitude weighted mean and cell count over each bounding box.

    The boxes are a short constant list, so a cell is matched to them by a filter over that
    list and no join is needed; sums are partial before the shuffle.
    """
    boxes = F.array(*[F.struct(F.lit(n).alias("region"), *[F.lit(float(v)).alias(k) for k, v in zip(("w", "e", "s", "n"), b)]) for n, b in regions.items()])
    inside = F.filter(boxes, lambda b: (F.col("lon") >= b["w"]) & (F.col("lon") <= b["e"]) & (F.col("lat") >= b["s"]) & (F.col("lat") <= b["n"]))
    weight = F.cos(F.radians("lat"))
    hit = cells.select(*by, "lat", F.col(value).alias("_v"), F.explode(inside).alias("b")).select(*by, F.col("b.region").alias("region"), "_v", weight.alias("_w"))
    return hit.groupBy(*by, "region").agg((F.sum(F.col("_v") * F.col("_w")) / F.sum("_w")).alias("mean"), F.count(F.lit(1)).alias("valid_cells"))


def fire_detections(rows: DataFrame, area: str, sensor: str) -> DataFrame:
    numbers = ("latitude", "longitude", "brightness", "frp", "confidence")
    return rows.select(*[to_double(c).alias(c) if c in numbers else F.col(c) for c in rows.columns], F.lit(area).alias("area"), F.lit(sensor).alias("source_sensor"))
