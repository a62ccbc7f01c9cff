import json

import pytest

from areaday.sources import documents
from areaday.sources.quarantine import EMPTY, MALFORMED, NO_LIST, OTHER_TYPE, Counts, Quarantine

GOOD = '[{"nom": "A", "codeRegion": "1", "code": "01", "population": 5},\n {"nom": "B"}]'


def write(folder, **texts):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in texts.items():
        (folder / f"{name}.json").write_text(text, encoding="utf-8")
    return str(folder)


@pytest.mark.parametrize(
    "text, reason",
    [
        (" ", EMPTY),
        (" \n\t", EMPTY),
        (GOOD[:-5], MALFORMED),
        ('{"message": "try later"}', NO_LIST),
        ("null", NO_LIST),
        ('"text"', NO_LIST),
        ('[{"nom": "A", "population": "many"}]', OTHER_TYPE),
        ('[{"nom": "A"}, 7]', OTHER_TYPE),
        ('[{"nom": "A"}, null]', OTHER_TYPE),
    ],
)
def test_a_broken_document_is_put_aside_whole(spark, tmp_path, rows, text, reason):
    aside = Quarantine(str(tmp_path / "aside"))
    path = write(tmp_path / "communes", good=GOOD, bad=text, none="[]")
    found = documents.read_communes(spark, path, quarantine=aside)
    assert rows(found, "commune", "code", "population") == [("A", "01", 5), ("B", None, None)]
    (bad,) = aside.read(spark).collect()
    assert (bad.reason, bad.text, bad.source) == (reason, text, "communes") and bad.document.endswith("bad.json")
    assert aside.counts == {"communes": Counts(3, 1, 2)}


def test_documents_under_a_key_and_per_line(spark, tmp_path, rows):
    aside = Quarantine(str(tmp_path / "aside"))
    lines = [
        json.dumps({"resources": [{"title": "a", "url": "u", "format": "csv"}, {}]}),
        json.dumps({"other": []}),
        json.dumps({"resources": {"title": "a"}}),
        json.dumps({"resources": [{"title": {"x": 1}}, 3]}),
        "[]",
        "{",
    ]
    path = write(tmp_path / "catalogue", lines="\n".join(lines))
    found = documents.read_catalogue(spark, path, multi_line=False, quarantine=aside)
    assert sorted(r.url for r in found.collect()) == ["", "u"]
    assert rows(aside.read(spark), "reason") == sorted([(NO_LIST,)] * 3 + [(MALFORMED,), (OTHER_TYPE,)], key=repr)


def test_reading_again_replaces_and_sources_stay_apart(spark, tmp_path, rows):
    aside = Quarantine(str(tmp_path / "aside"))
    path = write(tmp_path / "communes", good=GOOD, bad="[")
    for _ in range(2):
        documents.read_communes(spark, path, quarantine=aside)
    documents.read_postal_codes(spark, path, quarantine=aside)
    assert rows(aside.read(spark), "source", "reason") == [("communes", MALFORMED), ("postal_codes", MALFORMED)]


def test_without_a_quarantine_it_raises(spark, tmp_path):
    path = write(tmp_path / "communes", good=GOOD, bad='[{"nom": "A", "population": "many"}]')
    with pytest.raises(Exception):  # noqa: B017
        documents.read_communes(spark, path).collect()


def test_what_is_read_equals_the_reading_without(spark, tmp_path, rows):
    feature = {"properties": {"code": "1", "nom": "x"}, "geometry": {"type": "Point", "coordinates": [1.5, 2]}}
    path = write(tmp_path / "geojson", one=json.dumps({"features": [feature, {"properties": {}, "geometry": None}]}))
    aside = Quarantine(str(tmp_path / "aside"))
    assert rows(documents.read_geojson(spark, path, quarantine=aside)) == rows(documents.read_geojson(spark, path))
    assert aside.read(spark).isEmpty()


def test_a_file_without_any_byte_is_no_document(spark, tmp_path):
    aside = Quarantine(str(tmp_path / "aside"))
    path = write(tmp_path / "communes", good=GOOD, nothing="")
    assert documents.read_communes(spark, path, quarantine=aside).count() == 2
    assert aside.counts == {"communes": Counts(1, 0, 2)}
