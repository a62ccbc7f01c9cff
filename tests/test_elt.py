"""From landed files to the loaded table, a model, its predictions and the map."""

import datetime as dt
import json
import random
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from areaday.fixed import COUNT, WEATHER
from areaday.ml import training
from areaday.plans import elt, map_layer
from areaday.operators.ranking import latest_rows
from areaday.session import new_path
from areaday.sinks.files import json_records
from areaday.sinks.tables import Audit
from areaday.sources.quarantine import Counts, Quarantine

COMMUNES = ["77001", "77002", "77003"]
YEARS = [2022, 2023]


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    """Landed files, and the accidents they hold per commune and day."""
    rng, root, want = random.Random(11), tmp_path_factory.mktemp("landing"), {}
    for folder in ("accidents", "communes", "public_holidays", "school_holidays", "weather_history"):
        (root / folder).mkdir()
    for year in [2020, *YEARS]:
        lines = ["Num_Acc;jour;mois;an;dep;com" if year % 2 else "Accident_Id;jour;mois;an;dep;com"]
        for i in range(300):
            day, com = dt.date(year, 1, 1) + dt.timedelta(rng.randrange(365)), rng.choice([*COMMUNES, "77999"])
            dep = rng.choice(["77", "77", "2A"])
            lines.append(f"{i};{day.day:02};{day.month:02};{year};{dep};{com}")
            if dep == "77" and year in YEARS:
                want[com, day] = want.get((com, day), 0) + 1
        (root / "accidents" / f"caract-{year}.csv").write_text("\n".join(lines) + "\n")
    communes = [{"nom": c, "codeRegion": "11", "code": c, "population": int(c)} for c in COMMUNES]
    (root / "communes" / "77.json").write_text(json.dumps(communes, indent=1))
    for year in YEARS:
        (root / "public_holidays" / f"{year}.json").write_text(json.dumps({f"{year}-01-01": "Jour de l'an"}))
    fields = {
        "annee_scolaire": "2022-2023", "zones": "Zone C", "description": "Hiver",
        "start_date": "2023-02-17T23:00:00+00:00", "end_date": "2023-03-05T23:00:00+00:00",
    }
    (root / "school_holidays" / "all.json").write_text(json.dumps({"records": [{"fields": fields}]}, indent=1))
    weather = ["dt_iso," + ",".join(WEATHER)]
    for hour in range(48):
        moment = dt.datetime(2023, 1, 1) + dt.timedelta(hours=hour)
        weather.append(f"{moment} +0000 UTC," + ",".join([str(float(hour))] * 8))
    (root / "weather_history" / "w.csv").write_text("\n".join(weather) + "\n")
    return str(root), want


def test_training_set_of_the_files(spark, landing):
    root, accidents = landing
    rows = elt.training_set_from_files(spark, root, "77", 2025).collect()
    assert len(rows) == len(COMMUNES) * 730
    for r in rows:
        assert (r.jour, r.mois, r.an) == (r.date.day, r.date.month, r.date.year)
        assert r[COUNT] == accidents.get((r.com, r.date), 0)
        assert r.dep == "77" and r.population == int(r.com)
        assert r.public_holidays == ((r.mois, r.jour) == (1, 1))
        assert (r.zone_a, r.zone_b) == (False, False)
        assert r.zone_c == (dt.date(2023, 2, 18) <= r.date <= dt.date(2023, 3, 5))
        day = (r.date - dt.date(2023, 1, 1)).days
        if day in (0, 1):
            assert (r.temp, r.temp_min, r.temp_max) == (24 * day + 11.5, 24 * day, 24 * day + 23)
        else:
            assert r.temp is None and r.temp_max is None


def test_a_broken_department_does_not_stop_the_load(spark, landing, tmp_path):
    root, accidents = landing
    landed = shutil.copytree(root, tmp_path / "landing")
    (landed / "communes" / "78.json").write_text('[{"nom": "x", "codeRegion": "11", "code": "78001", "popul')
    with pytest.raises(Exception):  # noqa: B017
        elt.training_set_from_files(spark, str(landed), "77", 2025).collect()
    aside = Quarantine(str(tmp_path / "aside"))
    found = elt.training_set_from_files(spark, str(landed), "77", 2025, quarantine=aside)
    assert found.agg(F.sum(COUNT)).first()[0] == sum(n for (com, _), n in accidents.items() if com in COMMUNES)
    (bad,) = aside.read(spark).collect()
    assert bad.source == "communes" and bad.reason == "malformed" and bad.document.endswith("78.json")
    assert aside.counts == {"communes": Counts(2, 1, len(COMMUNES)), "school_holidays": Counts(1, 0, 1)}


def test_load_export_train_score_and_map(spark, landing):
    root, _ = landing
    table, audit = f"t_{uuid.uuid4().hex}", Audit(dt.datetime(2025, 3, 8), "elt", "load")
    loaded = elt.run(spark, root, table, audit, "77", 2025, new_path(spark, "table"))
    assert loaded == (len(COMMUNES) * 730, "2025-03-08 00:00:00")
    top = json_records(latest_rows(spark.table(table), 100, ["com"])).collect()
    assert len(top) == 100 and json.loads(top[0].record)["date"] == "2023-12-31"
    keyed = spark.table(table).withColumns(
        {"row": F.datediff("date", F.lit("2022-01-01").cast("date")).cast("bigint") * 100000 + F.col("population")}
    ).drop("execution_date", "dag_id", "task_id", "dep")
    numbered, mapping = training.imbalanced_features(keyed, ["public_holidays", "zone_a", "zone_b", "zone_c"], "row")
    assert sorted(tuple(r) for r in mapping.collect()) == [(c, i) for i, c in enumerate(COMMUNES)]
    trained = training.train_boosted(numbered, "row", rounds=2, threshold=0.5)
    scored = training.score(trained.model, numbered.drop("row", "accident"), trained.features)
    assert scored.count() == len(COMMUNES) * 730
    day = map_layer.of_day(scored, 2023, 1, 1).join(mapping, F.col("com") == F.col("id")).withColumn("com", F.col("commune"))
    features = spark.createDataFrame([(c, c) for c in [*COMMUNES, "77999"]], "code string, nom string")
    flags = {r.code: r.accident for r in map_layer.commune_flags(features, day).collect()}
    assert flags == {**{c: 1 for c in COMMUNES}, "77999": 0}
    assert training.days_by_commune(scored).count() <= len(COMMUNES)
