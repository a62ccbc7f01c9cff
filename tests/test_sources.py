import datetime as dt
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from areaday import schemas
from areaday.plans.catalogue import data_files, files_to_fetch, incomplete_years
from areaday.sinks import files as out
from areaday.sources import documents, files


def write(folder, **texts):
    folder.mkdir(exist_ok=True)
    for name, text in texts.items():
        (folder / name.replace("__", ".").replace("_", "-")).write_text(text, encoding="utf-8")
    return str(folder)


ACCIDENTS = {
    "caract_2023__csv": "Num_Acc;jour;mois;an;dep;com\n1;05;01;2023;77;77001\n2;05;01;2023;77;77001\n",
    "carcteristiques_2022__csv": "Accident_Id;jour;mois;an;dep;com;lum\n3;31;12;2022;77;77002;1\n4;31;12;2022;2A;2A004;1\n",
    "caract_2021__csv": "Num_Acc;jour;mois;an;dep;com\n5;01;01;2021;77;77001\n",
    "lieux_2023__csv": "Num_Acc;voie\n1;x\n",
}


def test_latest_files_are_united_by_column_name(spark, tmp_path, rows):
    folder = write(tmp_path / "accidents", **ACCIDENTS)
    read = files.read_accidents(spark, folder)
    assert rows(read, "id", "an", "com", "lum") == [
        ("1", "2023", "77001", None),
        ("2", "2023", "77001", None),
        ("3", "2022", "77002", "1"),
        ("4", "2022", "2A004", "1"),
    ]
    assert set(read.columns) == {"id", "jour", "mois", "an", "dep", "com", "lum"}


def test_listing_of_flat_files_and_of_an_empty_folder(spark, tmp_path, rows):
    folder = write(tmp_path / "accidents", **ACCIDENTS)
    listed = files.list_files(spark, folder)
    assert rows(listed, "name") == sorted((n.replace("__", ".").replace("_", "-"),) for n in ACCIDENTS)
    assert rows(files.recent_files(listed), "name") == [("caract-2023.csv",), ("carcteristiques-2022.csv",)]
    assert rows(files.files_by_year(listed), "year", "files_in_year") == [(2021, 1), (2022, 1), (2023, 1)]
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        files.list_files(spark, str(tmp_path / "empty"))
    with pytest.raises(FileNotFoundError):
        files.list_files(spark, str(tmp_path / "missing"))


def test_recent_counts_files_and_not_years(spark, rows):
    names = spark.createDataFrame([("car-a-2023",), ("car-b-2023",), ("car-2022",)], "name string")
    assert rows(files.recent_files(names, 2), "name") == [("car-a-2023",), ("car-b-2023",)]


def test_union_only_of_same_columns(spark, tmp_path, rows):
    folder = write(tmp_path / "x", a__csv="Num_Acc;dep\n1;77\n", b__csv="Accident_Id;dep\n2;77\n", c__csv="dep;Num_Acc\n7;3\n")
    paths = [f"{folder}/{n}.csv" for n in "abc"]
    assert rows(files.read_same_columns(spark, paths[:2], {"Accident_Id": "Num_Acc"})) == [("1", "77"), ("2", "77")]
    with pytest.raises(ValueError):
        files.read_same_columns(spark, paths, {"Accident_Id": "Num_Acc"})


def test_id_of_either_column_and_of_none(spark, rows):
    both = spark.createDataFrame([("a", None), (None, "b"), ("c", "d")], "Accident_Id string, Num_Acc string")
    assert rows(files.with_accident_id(both)) == [("a",), ("b",), ("c",)]
    with pytest.raises(ValueError):
        files.with_accident_id(both.toDF("x", "y"))


def test_typed_scan_checks_header_and_values(spark, tmp_path):
    folder = write(tmp_path / "x", good__csv="commune,id\na,0\n", header__csv="id,commune\n0,a\n", value__csv="commune,id\na,x\n")
    read = lambda name: files.read_typed(spark, f"{folder}/{name}.csv", schemas.COMMUNE_MAPPING).collect()
    assert [tuple(r) for r in read("good")] == [("a", 0)]
    for bad in ("header", "value"):
        with pytest.raises(Exception):
            read(bad)


def test_catalogue_rules(spark, tmp_path, rows):
    titles = [
        ("Usagers 2023", "csv"),
        ("Lieux 2023.csv", "csv"),
        ("CARACT 2023", "csv"),
        ("Caract 2023", "pdf"),
        ("Vehicules-immatricules-baac 2023", "csv"),
        ("Description des usagers", "csv"),
        ("Other", "csv"),
    ]
    resources = [{"title": t, "url": "u", "format": f} for t, f in titles] + [{"url": "v"}]
    (tmp_path / "c.json").write_text(json.dumps({"resources": resources}))
    read = documents.read_catalogue(spark, str(tmp_path / "c.json"))
    assert read.filter("title = 'noname' AND format = ''").count() == 1
    assert rows(data_files(read), "name") == [("caract_2023.csv",), ("lieux_2023.csv",), ("usagers_2023.csv",)]
    stored = spark.createDataFrame([("lieux_2023.csv",)], "name string")
    assert rows(files_to_fetch(read, stored), "name") == [("caract_2023.csv",), ("usagers_2023.csv",)]


def test_incomplete_years(spark, rows):
    names = [f"{k}_2022.csv" for k in "abcd"] + [f"{k}-2021.csv" for k in "abc"] + ["noyear.csv"]
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    assert rows(incomplete_years(frame)) == [("2021", 3)]


def test_public_holidays_of_year_files(spark, tmp_path):
    folder = tmp_path / "holidays"
    folder.mkdir()
    (folder / "2022.json").write_text(json.dumps({"2022-01-01": "old", "2023-01-01": "wrong"}))
    (folder / "2023.json").write_text(json.dumps({"2023-01-01": "new", "2023-07-14": "Fête"}))
    (folder / "2050.json").write_text(json.dumps({"2050-01-01": "late"}))
    read = documents.read_public_holidays(spark, str(folder), 2022, 2030)
    assert [tuple(r) for r in read.collect()] == [
        (dt.date(2022, 1, 1), "old"),
        (dt.date(2023, 1, 1), "new"),
        (dt.date(2023, 7, 14), "Fête"),
    ]


def test_school_holidays_in_the_span(spark, tmp_path):
    record = lambda year, zone: {
        "fields": {
            "annee_scolaire": year, "zones": zone, "description": "Hiver",
            "start_date": "2023-02-18T00:00:00+01:00", "end_date": "2023-03-06",
        }
    }
    document = {"records": [record("2022-2023", "Zone A"), record("2020-2021", "Zone B"), record("2027-2028", "Zone C")]}
    (tmp_path / "s.json").write_text(json.dumps(document, indent=1))
    read = documents.read_school_holidays(spark, str(tmp_path / "s.json"), 2025).collect()
    assert [tuple(r) for r in read] == [("Zone A", "Hiver", dt.datetime(2023, 2, 17, 23), dt.datetime(2023, 3, 6))]


def test_communes_of_many_files(spark, tmp_path, rows):
    commune = lambda code: {"nom": f"N{code}", "codeRegion": "11", "code": code, "population": 5, "codesPostaux": ["1", "2"]}
    for i, codes in enumerate([["01004", "77001"], ["2A004"]]):
        (tmp_path / f"{i}.json").write_text(json.dumps([commune(c) for c in codes]))
    assert rows(documents.read_communes(spark, str(tmp_path)), "code", "population") == [("01004", 5), ("2A004", 5), ("77001", 5)]
    assert rows(documents.read_postal_codes(spark, str(tmp_path)), "postal_codes") == [("1, 2",)] * 3


def test_fire_brigades_of_html(spark, tmp_path):
    table = """<table><thead><tr><th>Nom</th></tr></thead><tbody>
      <tr class="odd"><td headers="x"> <a href="#">CIS <b>Meaux</b></a>
      </td><td> Meaux &amp; Co&eacute; </td><td>77</td><td>more</td></tr>
      <tr><td>short</td><td>row</td></tr><TR><TD>B</TD><TD>C</TD><TD>D</TD></TR></tbody></table>"""
    payload = [{"command": "x"}, {"data": {"no": "text"}}, {"data": 7}, {"data": " \n"}, {"data": table}, {"data": "<tr>"}]
    (tmp_path / "a.json").write_text(json.dumps(payload, indent=1))
    (tmp_path / "b.json").write_text(json.dumps([{"data": "  "}]))
    got = sorted(map(tuple, documents.read_fire_brigades(spark, str(tmp_path)).collect()))
    assert got == [("B", "C", "D"), ("CIS Meaux", "Meaux & Coé", "77")]


GEO = {
    "type": "FeatureCollection",
    "features": [
        {
            "type": "Feature",
            "properties": {"code": "77001", "nom": "A"},
            "geometry": {"type": "Polygon", "coordinates": [[[2.0, 48.0], [3.5, 48.0], [2.0, 49.0]], [[2.1, 48.1], [2.2, 48.2]]]},
        },
        {
            "type": "Feature",
            "properties": {"code": "77002", "nom": "B"},
            "geometry": {"type": "Polygon", "coordinates": [[[1.0, 47.0], [1.5, 47.5]]]},
        },
        {
            "type": "Feature",
            "properties": {"code": "77003", "nom": "C"},
            "geometry": {"type": "MultiPolygon", "coordinates": [[[[2.0, 47.0], [2.5, 47.5]]], [[[2.0, 47.0], [5.0, 51.0]]]]},
        },
    ],
}


def test_geojson_and_extent(spark, tmp_path):
    from areaday.plans.map_layer import map_extent

    (tmp_path / "g.geojson").write_text(json.dumps(GEO, indent=1))
    read = documents.read_geojson(spark, str(tmp_path / "g.geojson"))
    assert sorted((r.code, r.nom, len(r.polygons)) for r in read.collect()) == [
        ("77001", "A", 1), ("77002", "B", 1), ("77003", "C", 2),
    ]
    assert tuple(map_extent(read).first()) == (1.0, 47.0, 5.0, 51.0, 3.0, 49.0)


def test_file_sinks(spark, tmp_path, rows):
    frame = spark.createDataFrame([(1, "é;x"), (2, None)], "a int, b string")
    path = out.write_csv(frame, str(tmp_path / "c"), sep=";")
    assert rows(files.read_strings(spark, path)) == [("1", "é;x"), ("2", None)]
    out.write_csv(frame.limit(0), path, sep=";", mode="ignore")
    assert files.read_strings(spark, path).count() == 2
    assert sorted(r.record for r in out.json_records(frame).collect()) == ['{"a":1,"b":"é;x"}', '{"a":2}']
    assert spark.read.json(out.write_json(frame, str(tmp_path / "j"))).count() == 2


PUBLISHED = [
    (schemas.PUBLIC_HOLIDAYS, [(dt.date(2023, 1, 1), "Jour de l'an")]),
    (schemas.SCHOOL_HOLIDAYS, [("Zone A", "Hiver", dt.datetime(2023, 2, 17, 23), dt.datetime(2023, 3, 5, 23))]),
    (schemas.COMMUNES, [("Ambérieu", "84", "01004", 14000), ("Ajaccio", "94", "2A004", None)]),
    (schemas.WEATHER_DAILY, [(dt.date(2023, 1, 1), 1.5, *[0.1] * 7)]),
    (schemas.ACCIDENT_COUNTS, [(1, 2, 2023, "2A", "2A004", 3)]),
]


@pytest.mark.parametrize("schema, data", PUBLISHED)
def test_published_tables_read_back_with_their_schema(spark, tmp_path, schema, data):
    path = out.write_csv(spark.createDataFrame(data, schema), str(tmp_path / "t"))
    assert sorted(tuple(r) for r in files.read_typed(spark, path, schema).collect()) == sorted(data)


def test_school_holidays_with_offsets_as_text(spark, tmp_path):
    text = "zone,type,start_date,end_date\nZone A,Hiver,2023-02-18T00:00:00+01:00,2023-03-06\n"
    (tmp_path / "s.csv").write_text(text)
    (row,) = files.read_typed(spark, str(tmp_path / "s.csv"), schemas.SCHOOL_HOLIDAYS).collect()
    assert (row.start_date, row.end_date) == (dt.datetime(2023, 2, 17, 23), dt.datetime(2023, 3, 6))


TEXT_ROWS = [
    ("1", 'say "hi", ok', "a;b"), ("2", "two\nlines\n", " spaces "), ("3", '"', ""), ("4", '""x""', "é"), ("5", ",", '\\"back\\'),
]


def test_files_with_one_header_are_one_scan(spark, tmp_path, rows):
    headers = ["id;dep", "dep;id;x", "y;id"]
    for i in range(90):
        names = headers[i % 3].split(";")
        (tmp_path / f"f {i:02d}.csv").write_text(headers[i % 3] + "\n" + "".join(";".join(f"{n}{i}" for n in names) + "\n" for _ in range(2)))
    (tmp_path / "empty.csv").write_text("")
    read = files.read_union(spark, [f"{tmp_path}/f {i:02d}.csv" for i in range(90)] + [f"{tmp_path}/empty.csv"])
    assert read.columns == ["id", "dep", "x", "y"]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3
    has = {"id": (0, 1, 2), "dep": (0, 1), "x": (1,), "y": (2,)}
    want = [tuple(f"{n}{i}" if i % 3 in has[n] else None for n in ("id", "dep", "x", "y")) for i in range(90) for _ in range(2)]
    assert rows(read) == sorted(want, key=repr)


def test_csv_dialect_is_that_of_pandas(spark, tmp_path, rows):
    frame = spark.createDataFrame(TEXT_ROWS, "id string, a string, b string")
    path = out.write_csv(frame.coalesce(1), str(tmp_path / "spark"), sep=";")
    (part,) = (tmp_path / "spark").glob("part-*")
    read = pd.read_csv(part, sep=";", dtype=str, keep_default_na=False)
    assert [tuple(r) for r in read.itertuples(index=False)] == TEXT_ROWS
    whole = [(i, a, b or None) for i, a, b in TEXT_ROWS]
    back = files.read_strings(spark, path, multi_line=True).fillna("", ["b"])
    assert rows(back) == sorted(TEXT_ROWS, key=repr)
    pd.DataFrame(TEXT_ROWS, columns=["id", "a", "b"]).to_csv(tmp_path / "pandas.csv", sep=";", index=False)
    assert rows(files.read_strings(spark, str(tmp_path / "pandas.csv"), multi_line=True)) == sorted(whole, key=repr)


def test_doubled_quotes_do_not_swallow_separators(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('id;rue;com\n1;"rue ""A""; B";77001\n')
    assert rows(files.read_strings(spark, str(tmp_path / "a.csv"))) == [("1", 'rue "A"; B', "77001")]


@pytest.mark.parametrize("line", ["1;a;EXTRA", "1"])
def test_rows_of_another_length_raise(spark, tmp_path, line):
    (tmp_path / "a.csv").write_text(f"id;v\n1;a\n{line}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_strings(spark, str(tmp_path / "a.csv")).select("id").collect()


LANDED = {
    "catalogue": (documents.read_catalogue, {"resources": [{"title": "t", "url": "u", "format": "csv"}]}),
    "communes": (documents.read_communes, [{"nom": "n", "codeRegion": "1", "code": "c", "population": 5}]),
    "postal": (documents.read_postal_codes, [{"nom": "n", "codesPostaux": ["1"]}]),
    "geojson": (documents.read_geojson, GEO),
    "school": (
        lambda spark, path: documents.read_school_holidays(spark, path, 2000),
        {"records": [{"fields": {"annee_scolaire": "2000-2001", "zones": "A", "description": "d", "start_date": "2000-01-01", "end_date": "2000-01-02"}}]},
    ),
    "public": (lambda spark, path: documents.read_public_holidays(spark, path, 2000, 2002), {"2001-01-01": "x"}),
    "brigades": (documents.read_fire_brigades, [{"data": "<table><tr></tr><tr><td>a</td><td>b</td><td>c</td></tr></table>"}]),
}


@pytest.mark.parametrize("name", LANDED)
def test_documents_that_are_cut_off_raise(spark, tmp_path, name):
    read, document = LANDED[name]
    text = json.dumps(document, indent=1)
    (tmp_path / "2001.json").write_text(text)
    assert read(spark, str(tmp_path / "2001.json")).count() >= 1
    (tmp_path / "2001.json").write_text(text[: len(text) - 4])
    with pytest.raises(Exception):
        read(spark, str(tmp_path / "2001.json")).collect()


def test_values_of_another_type_raise(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps([{"nom": "n", "codeRegion": "1", "code": "c", "population": 5.5}]))
    with pytest.raises(Exception):
        documents.read_communes(spark, str(tmp_path / "c.json")).collect()


def test_extent_takes_all_types_of_geometry(spark, tmp_path):
    from areaday.plans.map_layer import map_extent

    shapes = {
        "Point": [1, 2], "MultiPoint": [[3, 4], [5, 6]], "LineString": [[0, 9], [7, 1]], "MultiLineString": [[[2, 2], [8, 3]]],
    }
    features = [{"properties": {"code": k, "nom": k}, "geometry": {"type": k, "coordinates": c}} for k, c in shapes.items()]
    features.append({"properties": {"code": "none", "nom": "none"}, "geometry": None})
    (tmp_path / "g.json").write_text(json.dumps({"features": features}))
    read = documents.read_geojson(spark, str(tmp_path / "g.json"))
    assert read.count() == 5 and tuple(map_extent(read).first())[:4] == (0.0, 1.0, 8.0, 9.0)
    features[0]["geometry"]["type"] = "Blob"
    (tmp_path / "g.json").write_text(json.dumps({"features": features}))
    with pytest.raises(Exception, match="Blob"):
        documents.read_geojson(spark, str(tmp_path / "g.json")).collect()
