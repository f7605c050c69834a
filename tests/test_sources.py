import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.sources import names, rasters, vectors
from gridloom.streaming import windows


def test_extended_names(spark, tmp_path):
    spark.createDataFrame([(1, 2, 3, 4)], "id int, b1 int, b2 int, b3 int").write.parquet(str(tmp_path / "t.parquet"))
    got = names.read(spark, f"{tmp_path}/t.parquet?&bands=2:", ["b1", "b2", "b3"])
    assert got.columns == ["id", "b2", "b3"]
    names.write(got, f"{tmp_path}/o.csv?&header=true")
    assert names.read(spark, f"{tmp_path}/o.csv?&header=true&inferSchema=true").first().asDict() == {"id": 1, "b2": 3, "b3": 4}


@pytest.mark.parametrize("text, want", [("1", [0]), ("1,3", [0, 2]), ("2:4", [1, 2, 3]), (":2", [0, 1]), ("3:", [2, 3]), ("-1", [3]), ("3:1", [2, 1, 0])])
def test_bands(text, want):
    assert names.band_places(text, 4) == want


@pytest.mark.parametrize("text", ["0", "5", "a", "1::2", ""])
def test_bad_bands(text):
    with pytest.raises(ValueError):
        names.band_places(text, 4)


def test_cell_types(spark):
    f = spark.createDataFrame([(-3.0,), (254.6,), (900.0,)], "v double")
    assert [r[0] for r in names.cast_cells(f, "v", "uint8").collect()] == [0, 255, 255]


def test_maps(spark, tmp_path):
    cells = np.arange(12).reshape(3, 4)
    (tmp_path / "a.pgm").write_bytes(rasters.encode(cells))
    (tmp_path / "b.ppm").write_bytes(rasters.encode(np.stack([cells] * 3, 2)))
    got = rasters.read_maps(spark, str(tmp_path))
    assert got.count() == 24 and got.where("size(bands) = 3").count() == 12
    assert got.where("image like '%a.pgm' and row = 2 and col = 1").first()["bands"] == [9.0]
    assert rasters.tiles_of(got, 2).where("tile_row = 1").count() == 8
    assert spark.range(1).select(rasters.tile_address("http://t/{z}/{x}/{y}.png", 3, F.lit(1), F.lit(2))).first()[0] == "http://t/3/2/1.png"
    with pytest.raises(ValueError):
        rasters.decode(b"nothing")


def test_vectors():
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    for little in (True, False):
        assert vectors.read_wkb(vectors.write_wkb(3, [ring], little)) == ("Polygon", [ring])
        assert vectors.read_wkb(vectors.write_wkb(1, ring[:1], little)) == ("Point", ring[:1])
    kml = "<kml xmlns='x'><Placemark><name>P</name><Polygon><outerBoundaryIs><LinearRing><coordinates>0,0 1,0 1,1</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark></kml>"
    assert vectors.kml_rings(kml) == [("P", ring)]
    prj = 'PROJCS["A",GEOGCS["B",DATUM["D",SPHEROID["E",6378137.0,298.25]]],PROJECTION["Lambert"],PARAMETER["False_Easting",400000.0]]'
    got = vectors.coordinate_system(prj)
    assert got["kind"] == "projected" and got["parameters"] == {"false_easting": 400000.0} and got["ellipsoid"] == ("E", 6378137.0, 298.25)
    schema = vectors.feature_schema("<GMLFeatureClassList><GMLFeatureClass><PropertyDefn><Name>n</Name><Type>Integer</Type></PropertyDefn><GeomPropertyDefn><Name>g</Name></GeomPropertyDefn></GMLFeatureClass></GMLFeatureClassList>")
    assert schema.simpleString() == "struct<n:bigint,g:string>"


def test_stream_equals_table(spark, tmp_path):
    from .conftest import SF

    table = spark.read.parquet(f"{SF}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", "props")
    table.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = windows.windowed(windows.read_events(spark, str(tmp_path / "in")), "10 minutes", late="1 day")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("win").start()
    q.processAllAvailable()
    q.stop()
    rows = lambda f: sorted((r["window_start"], r["event_type"], r["n"]) for r in f.collect())
    assert rows(spark.table("win")) == rows(windows.windowed(table, "10 minutes"))
    assert windows.sessions(table, "2 minutes").agg(F.sum("n")).first()[0] == table.count()
    assert windows.deduplicated(table.union(table)).count() == table.count()
