"""Loading base tables."""

import pytest

from wardline.sources.schemas import SCHEMAS
from wardline.sources.standins import standin_tables
from wardline.sources.tables import Tables, from_catalog, from_frames, from_jdbc, from_parquet


def test_derived_tables_have_the_fixed_schemas(spark, sf_dir):
    t = standin_tables(spark, sf_dir)
    for name, schema in SCHEMAS.items():
        found = [(f.name, f.dataType) for f in getattr(t, name).schema.fields]
        assert found == [(f.name, f.dataType) for f in schema.fields], name


def test_parquet_and_catalog(spark, sf_dir, tmp_path):
    person = standin_tables(spark, sf_dir).person
    person.write.parquet(f"{tmp_path}/people")
    loaded = from_parquet(spark, str(tmp_path), {"person": "people"}).person
    assert sorted(loaded.collect()) == sorted(person.collect())

    loaded.createOrReplaceTempView("people_view")
    named = from_catalog(spark, names={"person": "people_view"}).person
    assert sorted(named.collect()) == sorted(person.collect())


def test_tables_load_once_and_only_when_asked(spark):
    asked = []

    def load(name):
        asked.append(name)
        return spark.range(1)

    t = Tables(load)
    assert t.visit is t.visit and asked == ["visit"]
    with pytest.raises(AttributeError):
        t.nothing  # noqa: B018


def test_from_frames(spark):
    frame = spark.range(1)
    assert from_frames({"visit": frame}).visit is frame


def test_large_tables_are_not_read_through_one_connection(spark):
    t = from_jdbc(spark, {"url": "jdbc:none:"}, key_ranges={})
    with pytest.raises(ValueError, match="key range"):
        t.obs  # noqa: B018


def test_lookup_rows_carry_the_given_keys_and_labels(spark, sf_dir):
    t = standin_tables(spark, sf_dir)
    types = {r.encounter_type_id: r.name for r in t.encounter_type.collect()}
    assert sorted(types) == list(range(1, 17))
    assert (types[3], types[4], types[11]) == ("Discharge", "Admission", "NeuroVisit")
    forms = {r.form_id: (r.name, r.encounter_type) for r in t.form.collect()}
    assert sorted(forms) == list(range(1, 18))
    assert forms[6] == ("Hospitalization", 15) and forms[17] == ("US Head Investigation", 13)
