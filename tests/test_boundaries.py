import csv
import io
import itertools
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from areaday import schemas
from areaday.sources import boundaries as bd
from areaday.sources import documents, files
from areaday.sources.boundaries import json_elements, quoted_records


@pytest.fixture
def splits_of(spark):
    """Files are cut into splits of that many bytes."""
    names = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": None}
    for name in names:
        names[name] = spark.conf.get(name)

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", str(size))

    yield cut
    for name, value in names.items():
        spark.conf.set(name, value)


CSV = 'id,text\n1,"a\nb"\n2,"say ""hi""\n\n,"\n\n3,plain\r\n4,"\n"\n5,""""\n6,"""\n"""\n7,é\n'


def parsed(text):
    rows = list(csv.reader(io.StringIO(text, newline="")))
    return sorted(tuple(r) for r in rows[1:] if r)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 12, 19, 33, 1000])
def test_quotes_and_line_breaks_on_every_edge_of_a_split(spark, tmp_path, splits_of, size):
    (tmp_path / "a.csv").write_bytes(CSV.encode())
    splits_of(size)
    found = files.read_typed(spark, str(tmp_path / "a.csv"), "id STRING, text STRING", multi_line=True)
    assert sorted(tuple(r) for r in found.collect()) == parsed(CSV)


def test_random_records_in_several_files(spark, tmp_path, splits_of):
    rng = random.Random(5)
    whole = []
    for k in range(3):
        out = io.StringIO(newline="")
        writer = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
        writer.writerow(["a b", "c"])
        for _ in range(120):
            row = ["".join(rng.choices('xé",;\n\r ', k=rng.randint(1, 9))) for _ in range(2)]
            writer.writerow(row)
            whole.append(tuple(row))
        (tmp_path / f"{k}.csv").write_bytes((b"\xef\xbb\xbf" if k == 1 else b"") + out.getvalue().encode())
    for size in (29, 777):
        splits_of(size)
        found = files.read_strings(spark, str(tmp_path), sep=",", multi_line=True)
        assert found.columns == ["a b", "c"]
        assert sorted(tuple(r) for r in found.collect()) == sorted(whole)


def test_one_large_file_is_read_by_several_tasks(spark, tmp_path, splits_of):
    rows = [(i, f'line "{i}"\nand more\n' * (1 + i % 3)) for i in range(20_000)]
    with open(tmp_path / "a.csv", "w", newline="") as out:
        csv.writer(out, lineterminator="\n").writerows([("id", "text"), *rows])
    splits_of(100_000)
    found = files.read_typed(spark, str(tmp_path / "a.csv"), "id INT, text STRING", multi_line=True)
    tasks = found.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 5 and sorted(tuple(r) for r in found.collect()) == rows


def test_files_that_end_within_quotes_or_have_other_headers_raise(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,v\n1,"open\n')
    with pytest.raises(ValueError, match="within quotes"):
        quoted_records(spark, str(tmp_path / "a.csv"))
    (tmp_path / "a.csv").write_text("id,v\n1,2\n")
    (tmp_path / "b.csv").write_text("v,id\n1,2\n")
    with pytest.raises(Exception, match="another header"):
        files.read_strings(spark, str(tmp_path), ",", multi_line=True).collect()
    with pytest.raises(ValueError, match="columns"):
        files.read_typed(spark, str(tmp_path / "a.csv"), "x INT, v INT", multi_line=True)
    (tmp_path / "a.csv").write_text("id,v\n1,2,3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_strings(spark, str(tmp_path / "a.csv"), ",", multi_line=True).collect()


def test_other_splits_than_the_first_ones_raise(spark, tmp_path, splits_of):
    (tmp_path / "a.csv").write_text(CSV)
    splits_of(20)
    found = quoted_records(spark, str(tmp_path / "a.csv"))
    splits_of(10)
    with pytest.raises(Exception, match="other splits"):
        found.select("record").collect()


def test_a_header_alone_and_an_empty_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v")
    assert files.read_strings(spark, str(tmp_path / "a.csv"), ",", multi_line=True).collect() == []
    (tmp_path / "a.csv").write_text("")
    assert files.read_typed(spark, str(tmp_path / "a.csv"), "id INT", multi_line=True).collect() == []


LISTS = [
    [{"a": 1}, {"b": {"c": [{"d": "}]"}]}}, {}, {"e": '\\"{[', "f}": "\\\\"}, {"g": "é\n"}],
    [],
    [{}],
]


def as_text(value, indent):
    return json.dumps(value, indent=indent, ensure_ascii=False)


def documents_of(elements):
    """The elements as a document that is their list, and as one that has it among other lists."""
    return {
        None: elements,
        "records": {
            "n": 3, "other": [{"x": 1}, 2, [{"records": [{"no": 1}]}]], "o": {"records": [{"no": 2}], "p": {}, "q": 1},
            'k"records': [{"no": 3}], "records": elements, "s": '"records":[{"no":4}]', "last": [{"y": 1}],
        },
    }


def elements_in_splits(text, size, key):
    """The elements by the functions that tasks run, in splits of ``size`` bytes."""
    data = text.encode()
    at, batches = 0, []
    for piece in data.removesuffix(b"}").split(b"}") if data else []:
        start = at // size * size
        row = (piece, "f", start, min(size, len(data) - start), len(data))
        batches.append(pa.record_batch([pa.array([v]) for v in row], names=["value", *bd.SPLIT]))
        at += len(piece) + 1
    counted = [Row(**r) for batch in bd.bracket_changes(iter(batches)) for r in batch.to_pylist()]
    totals = {}
    for row in counted:  # one row per split and call, as all pieces of a split are in one task
        assert totals.setdefault(row.start, row) is row
    starts = bd.bracket_starts(counted)
    rows = []
    for split, part in itertools.groupby(batches, lambda b: tuple(b.column(n)[0].as_py() for n in bd.SPLIT)):
        split = bd.Split(*split)
        cutter = bd.PiecesToElements(split, starts.at(split, (0, 0)), key)
        for batch in part:
            rows += [(split.start, *row) for row in cutter.feed(batch.column("value").to_pylist())]
        rows += [(split.start, *row) for row in cutter.finish()]
    found, open_, context = [], None, None
    for _, same in itertools.groupby(rows, lambda r: r[0]):
        same = list(same)
        for _, place, wanted, value in same:
            wanted = context if wanted is None else wanted
            if place == bd.RECORD and wanted:
                found.append(value)
            elif place == bd.HEAD and open_:
                open_ = (open_[0], open_[1] + value)
                if open_[1].count(b"{") and is_whole(open_[1]):
                    found += [open_[1]] if open_[0] else []
                    open_ = None
            elif place == bd.TAIL:
                open_ = (wanted, value)
            elif place == bd.STRAY:
                assert not wanted
        context = same[-1][2] if same[-1][2] is not None else context
    return [json.loads(v) for v in found]


def is_whole(value):
    try:
        json.loads(value)
        return True
    except ValueError:
        return False


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("key", [None, "records"])
def test_elements_with_signs_on_every_edge_of_a_split(indent, key):
    for elements in LISTS:
        text = as_text(documents_of(elements)[key], indent)
        for size in (*range(1, 60), *range(60, len(text.encode()) + 2, 7)):
            assert elements_in_splits(text, size, key) == elements, size


@pytest.mark.parametrize("size", [2500, 3001])
@pytest.mark.parametrize("key", [None, "records"])
def test_elements_of_several_files(spark, tmp_path, splits_of, size, key):
    lists = [elements * 60 for elements in LISTS]
    for i, elements in enumerate(lists):
        (tmp_path / f"{i}.json").write_text(as_text(documents_of(elements)[key], i % 2 or None) + "\n" * (i % 2))
    splits_of(size)
    found = json_elements(spark, str(tmp_path), key).collect()
    assert sorted(as_text(json.loads(r.element), None) for r in found) == sorted(as_text(x, None) for e in lists for x in e)


def test_a_large_document_is_read_by_several_tasks(spark, tmp_path, splits_of):
    n = 100_000
    records = [{"fields": {"annee_scolaire": "2000-2001", "zones": f"Zone {i}", "description": "d}", "start_date": "2000-01-01", "end_date": "2000-01-02"}} for i in range(n)]
    (tmp_path / "a.json").write_text(json.dumps({"nhits": n, "records": records, "facets": [{"name": "x"}]}))
    splits_of(1_000_000)
    found = documents.read_school_holidays(spark, str(tmp_path / "a.json"), 2000)
    assert found.select(F.spark_partition_id()).distinct().count() > 5
    assert found.count() == n and found.select("zone").distinct().count() == n


@pytest.mark.parametrize(
    "text",
    ['[{"a":1},2]', '[{"a":1}{"a":2}]', '[{"a":1},[{"a":2}]]', '[{"a":1},{"a":2}', '[{"a":1},{"a":2}]]', '[{"a":1},null]', '["a"]', '[{"a":"]}]'],
)
@pytest.mark.parametrize("size", [12, 100])
def test_other_things_in_lists_and_broken_documents_raise(spark, tmp_path, splits_of, text, size):
    splits_of(size)
    (tmp_path / "a.json").write_text(text)
    (tmp_path / "b.json").write_text('{"k":' + text + ',"l":[1]}')
    for name, key in (("a", None), ("b", "k")):
        with pytest.raises(Exception, match="something else|cut off"):
            json_elements(spark, str(tmp_path / f"{name}.json"), key).collect()


def test_several_documents_in_one_file(spark, tmp_path, splits_of):
    splits_of(15)
    (tmp_path / "a.json").write_text('[{"a":1}]\n[]\n[{"a":2},{"a":3}]\n')
    assert sorted(r.element for r in json_elements(spark, str(tmp_path / "a.json")).collect()) == ['{"a":1}', '{"a":2}', '{"a":3}']


def test_geojson_and_communes_in_small_splits(spark, tmp_path, splits_of):
    n = 300
    features = [
        {"type": "Feature", "properties": {"code": str(i), "nom": "n}"}, "geometry": {"type": "Polygon", "coordinates": [[[i, 0], [1, 1], [0, i]]]}}
        for i in range(n)
    ]
    (tmp_path / "g.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    (tmp_path / "c.json").write_text(json.dumps([{"nom": f"n{i}", "code": str(i), "codesPostaux": ["1", "2"]} for i in range(n)], indent=2))
    splits_of(3000)
    assert sorted(int(r.code) for r in documents.read_geojson(spark, str(tmp_path / "g.json")).collect()) == list(range(n))
    assert sorted(int(r.code) for r in documents.read_communes(spark, str(tmp_path / "c.json")).collect()) == list(range(n))
    assert documents.read_postal_codes(spark, str(tmp_path / "c.json")).columns == ["commune", "postal_codes"]
    assert schemas.COMMUNES_JSON.startswith("nom")
