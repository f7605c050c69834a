"""Extended file names: ``path?&key=value&bands=1,3:5`` opens a table with options and some of its bands."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class ExtendedName:
    path: str
    options: dict[str, str] = field(default_factory=dict)

    @property
    def bands(self) -> str | None:
        return self.options.get("bands")


def parse_name(name: str) -> ExtendedName:
    """Path and options; an option without a value is 'true'."""
    path, _, rest = name.partition("?")
    out = ExtendedName(path)
    for part in filter(None, rest.split("&")):
        key, eq, value = part.partition("=")
        out.options[key.strip().lower()] = value.strip() if eq else "true"
    return out


def band_places(text: str, count: int) -> list[int]:
    """0-based places of 1-based bands: ``2``, ``1:3``, ``3:`` (to the end), ``:2`` (from the first), negative from the end, by commas."""

    def place(x: str) -> int:
        k = int(x)
        k = count + k if k < 0 else k - 1
        if not 0 <= k < count:
            raise ValueError(f"band {x} of {count}")
        return k

    out: list[int] = []
    for part in text.split(","):
        part = part.strip()
        if not re.fullmatch(r"-?\d+|(-?\d+)?:(-?\d+)?", part):
            raise ValueError(f"bands {text!r}")
        low, colon, high = part.partition(":")
        if not colon:
            out.append(place(low))
        else:
            a, b = (place(low) if low else 0), (place(high) if high else count - 1)
            out += range(a, b + 1) if a <= b else range(a, b - 1, -1)
    return out


FORMATS = {".parquet": "parquet", ".orc": "orc", ".csv": "csv", ".json": "json", ".txt": "text"}


def read(spark: SparkSession, name: str, bands: list[str] | None = None, schema=None) -> DataFrame:
    """The table of an extended name. ``format=`` overrides the file's ending; other options go to the reader; of
    ``bands`` (the value columns in order) those that the name picks are kept, so a columnar scan reads no others."""
    n = parse_name(name)
    options = {k: v for k, v in n.options.items() if k not in ("bands", "format")}
    kind = n.options.get("format") or next((f for end, f in FORMATS.items() if n.path.rstrip("/").endswith(end)), "parquet")
    reader = spark.read.format(kind).options(**options)
    frame = (reader.schema(schema) if schema else reader).load(n.path)
    if n.bands and bands:
        chosen = {bands[k] for k in band_places(n.bands, len(bands))}
        frame = frame.select(*[c for c in frame.columns if c not in bands or c in chosen])
    return frame


def write(frame: DataFrame, name: str, mode: str = "error") -> None:
    n = parse_name(name)
    kind = n.options.get("format") or next((f for end, f in FORMATS.items() if n.path.endswith(end)), "parquet")
    by = [c for c in n.options.get("partition", "").split(",") if c]
    writer = frame.write.format(kind).mode(mode).options(**{k: v for k, v in n.options.items() if k not in ("format", "partition")})
    (writer.partitionBy(*by) if by else writer).save(n.path)


def database(spark: SparkSession, url: str, table: str, user: str | None = None, password: str | None = None, column: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 8) -> DataFrame:
    """A table over JDBC, read in ``parts`` ranges of a numeric column where one is named."""
    options = {"url": url, "dbtable": table} | ({"user": user} if user else {}) | ({"password": password} if password else {})
    if column and bounds:
        options |= {"partitionColumn": column, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]), "numPartitions": str(parts)}
    return spark.read.format("jdbc").options(**options).load()


# Cell types of rasters by name, and the Spark types that hold them without narrowing.
CELL_TYPES = {"uint8": "short", "int16": "short", "uint16": "int", "int32": "int", "uint32": "long", "int64": "long", "float32": "float", "float64": "double"}


def cast_cells(frame: DataFrame, column: str, cell_type: str) -> DataFrame:
    """Cells rounded and clamped to a raster type's range, held in the Spark type that fits."""
    bits = int(re.sub(r"\D", "", cell_type))
    if cell_type.startswith("float"):
        return frame.withColumn(column, F.col(column).cast(CELL_TYPES[cell_type]))
    low, high = (0, 2**bits - 1) if cell_type.startswith("u") else (-(2 ** (bits - 1)), 2 ** (bits - 1) - 1)
    return frame.withColumn(column, F.greatest(F.lit(low), F.least(F.lit(high), F.round(column))).cast(CELL_TYPES[cell_type]))
