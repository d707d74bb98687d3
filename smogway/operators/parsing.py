"""Raw JSON records to typed rows.

`classify_*` adds the typed columns and a `reason` (NULL for a good record). Callers take `accepted` or
`rejected`, or write the classified frame once and split it later.

Records of the canonical shape are read with a typed schema. Only the others are parsed into VARIANT,
which can tell a missing key from an explicit null and a number from a quoted one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogway.functions import json_fields as J
from smogway.functions.numbers import nan_to_null
from smogway.functions.spatial import grid_cell
from smogway.functions.timestamps import TimeLike, parse_instant, time_literal
from smogway.operators.quality import dedupe_first, validate_columns
from smogway.schemas import READINGS, SPEED_VIEW, names
from smogway.settings import DEFAULTS, Settings


@dataclass(frozen=True)
class ParsedRecords:
    """Both outcomes of a parse, over one classified frame."""

    classified: DataFrame
    columns: list[str]

    @property
    def accepted(self) -> DataFrame:
        return self.classified.where(F.col("reason").isNull()).select(*self.columns)

    @property
    def rejected(self) -> DataFrame:
        return self.classified.where(F.col("reason").isNotNull()).select("reason", F.col("_raw").alias("raw"))


def _other_columns(raw: DataFrame, text: str) -> list[str]:
    return [c for c in raw.columns if c != text]


def _typed(records: DataFrame, typed: dict[str, Column], raw: DataFrame, text: str) -> DataFrame:
    return J.evaluate_once(records, typed).select(
        *typed, F.col(text).alias("_raw"), *_other_columns(raw, text)
    )


# --- traffic -----------------------------------------------------------------------------------


_TYPED_TRAFFIC = (
    "flowSegmentData: struct<currentSpeed: double, freeFlowSpeed: double,"
    " coordinates: struct<coordinate: array<struct<latitude: double, longitude: double>>>>,"
    " _fetched_at: string"
)


def classify_traffic(
    raw: DataFrame,
    as_of: TimeLike,
    text: str = "value",
    query_lat: Column | None = None,
    query_lon: Column | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Typed view of raw traffic responses, one row in, one row out.

    `as_of`, a point in time or a column of `raw`, stamps records without a usable fetch time. `query_lat`/`query_lon` stand in for a missing
    road position. Columns of `raw` other than `text` are carried along.
    """
    validate_columns(raw, [text], "raw traffic")
    typed = raw.withColumns({"_typed": J.parse_typed(F.col(text), _TYPED_TRAFFIC)})
    spot = F.get(F.col("_typed.r.flowSegmentData.coordinates.coordinate"), F.lit(0))
    typed = typed.withColumns(
        {
            "_t_speed": F.col("_typed.r.flowSegmentData.currentSpeed"),
            "_t_free": F.col("_typed.r.flowSegmentData.freeFlowSpeed"),
            "_t_lat": spot["latitude"],
            "_t_lon": spot["longitude"],
            "_t_fetched": F.col("_typed.r._fetched_at"),
            "_intact": F.col("_typed.damaged").isNull(),
        }
    )
    canonical = (
        F.col("_intact")
        & J.is_finite(F.col("_t_speed"))
        & ((F.col("_t_speed") > 0) | J.is_finite(F.col("_t_free")))  # standing traffic: the free-flow speed counts
        & J.is_finite(F.col("_t_lat"))
        & J.is_finite(F.col("_t_lon"))
    )
    records = typed.withColumns({"_canonical": canonical})
    is_canonical = F.col("_canonical")
    records = records.withColumns({"_record": F.when(~is_canonical, J.parse_lenient(F.col(text)))})
    record = F.col("_record")

    records = records.withColumn("_top", J.members(record))
    records = records.withColumn("_segment", J.member(F.col("_top"), "flowSegmentData"))
    records = records.withColumn("_flow", J.members(F.col("_segment")))
    records = records.withColumn("_path", J.members(J.member(F.col("_flow"), "coordinates")))
    records = records.withColumn("_point", J.members(J.first_element(J.member(F.col("_path"), "coordinate"))))
    records = records.withColumns(
        {
            "_current": J.member(F.col("_flow"), "currentSpeed"),
            "_free": J.member(F.col("_flow"), "freeFlowSpeed"),
            "_lat": J.member(F.col("_point"), "latitude"),
            "_lon": J.member(F.col("_point"), "longitude"),
            "_fetched": F.when(is_canonical, F.col("_t_fetched")).otherwise(
                J.as_text(J.member(F.col("_top"), "_fetched_at"))
            ),
        }
    )

    def speed(value: Column) -> Column:
        # A missing key counts as zero; an explicit null or a quoted number makes the record bad.
        return F.when(value.isNull(), F.lit(0.0)).otherwise(J.strict_number(value))

    records = records.withColumns(
        {
            "_cur": F.when(is_canonical, F.col("_t_speed")).otherwise(speed(F.col("_current"))),
            "_alt": F.when(is_canonical, F.col("_t_free")).otherwise(speed(F.col("_free"))),
            "_lat_n": F.when(is_canonical, F.col("_t_lat")).otherwise(J.strict_number(F.col("_lat"))),
            "_lon_n": F.when(is_canonical, F.col("_t_lon")).otherwise(J.strict_number(F.col("_lon"))),
        }
    )
    cur, alt = F.col("_cur"), F.col("_alt")
    moving = ~F.isnan(cur) & (cur > 0)
    chosen = F.when(cur.isNull(), F.lit(None)).when(moving, cur).otherwise(alt)
    records = records.withColumns({"_kmh": chosen * F.lit(settings.kmh_per_ms)})

    def unusable(value: Column, number: Column) -> Column:
        return value.isNotNull() & ~F.is_variant_null(value) & (number.isNull() | F.isnan(number))

    has_point = (
        F.col("_lat").isNotNull()
        & F.col("_lon").isNotNull()
        & ~F.is_variant_null(F.col("_lat"))
        & ~F.is_variant_null(F.col("_lon"))
    )
    bad_point = has_point & (
        unusable(F.col("_lat"), F.col("_lat_n")) | unusable(F.col("_lon"), F.col("_lon_n"))
    )
    kmh = F.col("_kmh")
    is_positive = kmh.isNotNull() & (F.isnan(kmh) | (kmh > 0))
    failure = (
        F.when(is_canonical, F.lit("non_positive_speed"))
        .when(record.isNull(), F.lit("invalid_json"))
        .when(F.col("_top").isNull(), F.lit("not_an_object"))
        .when(J.is_blank(F.col("_segment")), F.lit("no_flow_segment"))
        .when(F.col("_flow").isNull(), F.lit("bad_flow_segment"))
        .when(kmh.isNull(), F.lit("bad_speed"))
        .otherwise(F.lit("non_positive_speed"))
    )
    reason = F.when(is_positive, F.when(bad_point, F.lit("bad_coordinates"))).otherwise(failure)

    def position(number: str, fallback: Column | None) -> Column:
        return F.col(number) if fallback is None else F.coalesce(F.col(number), fallback)

    fetched = parse_instant(F.col("_fetched"), settings.timezone)
    typed = {
        "timestamp": F.coalesce(fetched, time_literal(as_of, False, settings.timezone)),
        "segment_id": grid_cell(position("_lat_n", query_lat), position("_lon_n", query_lon)),
        "velocity": nan_to_null(F.round(kmh, 2)),
        "reason": reason,
    }
    return _typed(records, typed, raw, text)


def parse_traffic(raw: DataFrame, as_of: TimeLike, **options) -> ParsedRecords:
    """Readings (timestamp, segment_id, velocity in km/h) and the rejected records."""
    text = options.get("text", "value")
    classified = classify_traffic(raw, as_of, **options)
    return ParsedRecords(classified, names(READINGS) + _other_columns(raw, text))


# --- air quality -------------------------------------------------------------------------------

# Fixed order of preference inside a {local, utc} time object.
_TIME_KEYS = ("local", "LOCAL", "utc", "UTC")


def _time_in(value: Column, object_members: Column) -> Column:
    """Time text of a value that is a scalar or a time object.

    The array functions also end the generated code here: with four unrolled cascades it would be too
    long for the JVM to compile.
    """
    keys = F.array(*[F.lit(key) for key in _TIME_KEYS])
    texts = F.transform(keys, lambda key: J.non_empty(J.as_text(F.try_element_at(object_members, key))))
    first = F.get(F.filter(texts, lambda text: text.isNotNull()), F.lit(0))
    return F.when(object_members.isNotNull(), first).otherwise(J.non_empty(J.as_text(value)))


def _with_time_text(records: DataFrame) -> DataFrame:
    """Add `_measured_text`: the time of `date`, else of `datetime`, else the start or end of the period."""

    def either(camel: str, snake: str) -> Column:
        first = J.member(F.col("_period"), camel)
        return F.when(J.is_blank(first), J.member(F.col("_period"), snake)).otherwise(first)

    records = records.withColumns(
        {
            "_date": J.member(F.col("_top"), "date"),
            "_datetime": J.member(F.col("_top"), "datetime"),
            "_period": J.members(J.member(F.col("_top"), "period")),
        }
    )
    records = records.withColumns(
        {"_from": either("datetimeFrom", "datetime_from"), "_to": either("datetimeTo", "datetime_to")}
    )
    names_of_times = ["_date", "_datetime", "_from", "_to"]
    records = records.withColumns({f"{name}_object": J.members(F.col(name)) for name in names_of_times})

    def time_of(name: str, text_only: bool = False) -> Column:
        value, fields = F.col(name), F.col(f"{name}_object")
        found = _time_in(value, fields)
        return F.when(fields.isNotNull() | J.is_text(value), found) if text_only else found

    direct = F.when(F.col("_date").isNotNull(), time_of("_date")).when(
        F.col("_datetime").isNotNull(), time_of("_datetime")
    )
    text = F.coalesce(direct, time_of("_from", True), time_of("_to", True))
    return records.withColumn("_measured_text", text)


def _station_name(top: Column, location: Column, location_members: Column) -> Column:
    named = (
        F.when(J.is_blank(location), F.lit(None))
        .when(
            location_members.isNotNull(),
            F.coalesce(*[J.as_text(J.member(location_members, key)) for key in ("name", "id")]),
        )
        .otherwise(J.as_text(location))
    )
    return F.coalesce(named, J.as_text(J.member(top, "locationName")), F.lit("Unknown"))


_TYPED_AIR = (
    "date: string, datetime: string, period: struct<datetimeFrom: struct<local: string>>, value: double,"
    " parameter: struct<name: string>, location: string, coordinates: struct<latitude: double, longitude: double>"
)


def classify_air(
    raw: DataFrame, text: str = "value", settings: Settings = DEFAULTS
) -> DataFrame:
    """Typed view of raw air measurements, one row in, one row out. Other columns are carried along."""
    validate_columns(raw, [text], "raw air quality")
    # Without this key no record is canonical; reading it with types would be in vain.
    may_be_canonical = F.col(text).contains('"local"')
    typed = raw.withColumns({"_typed": F.when(may_be_canonical, J.parse_typed(F.col(text), _TYPED_AIR))})
    typed = typed.withColumns(
        {
            "_t_time": F.col("_typed.r.period.datetimeFrom.local"),
            "_t_value": F.col("_typed.r.value"),
            "_t_name": F.lower(F.col("_typed.r.parameter.name")),
            "_t_location": F.col("_typed.r.location"),
            "_t_lat": F.col("_typed.r.coordinates.latitude"),
            "_t_lon": F.col("_typed.r.coordinates.longitude"),
            "_direct": F.coalesce(F.col("_typed.r.date"), F.col("_typed.r.datetime")),
            "_intact": F.col("_typed.damaged").isNull(),
        }
    )
    canonical = (
        F.col("_intact")
        & F.col("_direct").isNull()
        & (F.col("_t_time") != "")
        & J.is_finite(F.col("_t_value"))
        & (F.col("_t_name").contains("pm25") | F.col("_t_name").contains("pm2.5"))
        & F.col("_t_location").rlike(r"^[^\[{]")
        & ~F.col("_t_location").isin("false", "0")
    )
    records = typed.withColumns({"_canonical": F.coalesce(canonical, F.lit(False))})
    is_canonical = F.col("_canonical")
    records = records.withColumns({"_record": F.when(~is_canonical, J.parse_lenient(F.col(text)))})
    record = F.col("_record")
    top = F.col("_top")
    records = _with_time_text(records.withColumn("_top", J.members(record)))
    records = records.withColumns(
        {
            "_time_text": F.when(is_canonical, F.col("_t_time")).otherwise(F.col("_measured_text")),
            "_value": J.member(top, "value"),
            "_parameter": J.member(top, "parameter"),
            "_location": J.member(top, "location"),
            "_spot": J.members(J.member(top, "coordinates")),
        }
    )
    records = records.withColumns(
        {
            "_parameter_object": J.members(F.col("_parameter")),
            "_location_object": J.members(F.col("_location")),
        }
    )
    records = records.withColumns(
        {
            "_parameter_name": J.member(F.col("_parameter_object"), "name"),
            "_location_spot": J.members(J.member(F.col("_location_object"), "coordinates")),
        }
    )
    records = records.withColumns(
        {
            "_measured": parse_instant(F.col("_time_text"), "UTC"),
            "_number": F.when(is_canonical, F.col("_t_value")).otherwise(J.as_number(F.col("_value"))),
        }
    )
    parameter, parameter_name = F.col("_parameter"), F.col("_parameter_name")
    described = F.when(
        F.col("_parameter_object").isNotNull(), F.coalesce(J.as_text(parameter_name), F.lit(""))
    ).otherwise(F.coalesce(J.as_text(parameter), F.lit("none")))
    pollutant = F.lower(described)
    is_pm25 = parameter.isNull() | pollutant.contains("pm25") | pollutant.contains("pm2.5")
    unnamed = parameter_name.isNotNull() & ~J.is_text(parameter_name)

    value = F.col("_value")
    failure = (
        F.when(is_canonical, F.lit("bad_timestamp"))
        .when(record.isNull(), F.lit("invalid_json"))
        .when(top.isNull(), F.lit("not_an_object"))
        .when(F.col("_time_text").isNull(), F.lit("missing_timestamp"))
        .when(F.col("_measured").isNull(), F.lit("bad_timestamp"))
        .when(unnamed, F.lit("bad_parameter"))
        .when(value.isNull() | F.is_variant_null(value), F.lit("missing_value"))
        .when(~is_pm25, F.lit("not_pm25"))
        .otherwise(F.lit("bad_value"))
    )
    usable = F.col("_number").isNotNull() & is_pm25 & ~unnamed
    good = F.col("_measured").isNotNull() & F.when(is_canonical, F.lit(True)).otherwise(usable)
    def coordinate(name: str, typed_column: str) -> Column:
        # One object gives both: the record's own, or its location's where that is missing or empty.
        own = F.coalesce(F.size("_spot") > 0, F.lit(False))
        of = {spot: J.as_number(J.member(F.col(spot), name)) for spot in ("_spot", "_location_spot")}
        nested = F.when(own, of["_spot"]).otherwise(of["_location_spot"])
        return F.when(is_canonical, F.col(typed_column)).otherwise(nested)

    typed = {
        "timestamp": F.col("_measured"),
        "location": F.when(is_canonical, F.col("_t_location")).otherwise(
            _station_name(top, F.col("_location"), F.col("_location_object"))
        ),
        "pm25": nan_to_null(F.col("_number")),
        "latitude": coordinate("latitude", "_t_lat"),
        "longitude": coordinate("longitude", "_t_lon"),
        "reason": F.when(~good, failure),
    }
    return _typed(records, typed, raw, text)


def parse_air(raw: DataFrame, **options) -> ParsedRecords:
    """PM2.5 measurements (timestamp, location, pm25, latitude, longitude) and the rejected records."""
    text = options.get("text", "value")
    return ParsedRecords(
        classify_air(raw, **options), names(SPEED_VIEW) + _other_columns(raw, text)
    )


def air_measurements(raw: DataFrame, order_by: str = "ingest_seq", **options) -> DataFrame:
    """Accepted measurements with the first arrival kept per (timestamp, location), by the column `order_by` of `raw`."""
    validate_columns(raw, [order_by], "raw air quality")
    accepted = parse_air(raw, **options).accepted
    first = dedupe_first(accepted, ["timestamp", "location"], [order_by])
    return first.select(*names(SPEED_VIEW))


def air_payload(
    flat: DataFrame,
    label: Column | None = None,
    interval: Column | None = None,
) -> DataFrame:
    """The canonical raw JSON of flat measurements, i.e. the inverse of `parse_air`.

    Expects utc_from, local_from, utc_to, local_to, value, parameter, latitude, longitude, location;
    empty coordinates are left out.
    """

    def period_end(utc: str, local: str) -> Column:
        return F.struct(F.col(utc).alias("utc"), F.col(local).alias("local"))

    located = F.col("latitude").isNotNull() | F.col("longitude").isNotNull()
    payload = F.struct(
        F.struct(
            (F.lit("raw") if label is None else label).alias("label"),
            (F.lit("01:00:00") if interval is None else interval).alias("interval"),
            period_end("utc_from", "local_from").alias("datetimeFrom"),
            period_end("utc_to", "local_to").alias("datetimeTo"),
        ).alias("period"),
        F.col("value"),
        F.struct(F.col("parameter").alias("name")).alias("parameter"),
        F.when(located, F.struct("latitude", "longitude")).alias("coordinates"),
        F.col("location"),
    )
    built = ["utc_from", "local_from", "utc_to", "local_to", "value", "parameter", "latitude", "longitude", "location"]
    kept = [c for c in flat.columns if c not in built]
    return flat.select(F.to_json(payload).alias("value"), *kept)
