import pytest

from cohortloom import FeatureSpec, PipelineSpec
from cohortloom.operators.features import CATALOGUE_SCHEMA, catalogue
from cohortloom.sources.writers import write_json
from cohortloom.spec import describe_window, window_millis, window_months

DAYS = [1, 3, 7, 14, 30, 60, 90]


def login_config(**changes):
    on_first = [True, False, False, True]
    config = {
        "feature_category": "login_hist_v1",
        "feature_type": "batch",
        "created_by": "someone",
        "team_name": "team",
        "entities": ["customer_id", "partition_date"],
        "col_agg_dict": {
            "login_id": {"conditions": on_first, "aggregations": ["COUNT"]},
            "is_ios": {"conditions": on_first, "aggregations": ["MIN", "MAX", "AVG"]},
            "scaled_diff_login_unix_ts": {"conditions": on_first, "aggregations": ["MIN", "MAX", "AVG"]},
            "login_unix_ts": {"conditions": on_first, "aggregations": ["MIN", "MAX"]},
        },
        "condition_name_0": ["TRUE", {"is_ios": "is_ios"}, {"is_notios": "(NOT is_ios)"}],
        "condition_name_1": ["TRUE"],
        "condition_name_2": ["TRUE"],
        "time_cond_dict": [f"l{d}d" for d in DAYS],
    }
    return config | changes


def test_login_names():
    names = [f.name for f in FeatureSpec.from_dict(login_config()).features()]
    assert len(names) == len(set(names)) == 189
    assert names[0] == "count_login_id_l1d"
    assert "avg_is_notios_scaled_diff_login_unix_ts_l90d" in names
    assert "max_is_ios_is_ios_l14d" in names
    assert {min(map(len, names)), max(map(len, names))} == {14, 44}


def test_second_spec_size():
    columns = login_config()["col_agg_dict"]
    columns.pop("login_unix_ts")
    assert len(FeatureSpec.from_dict(login_config(col_agg_dict=columns)).features()) == 147


def test_name_report():
    report = FeatureSpec.from_dict(login_config()).name_report()
    assert report["total_features"] == 189 and report["violations"] == []
    assert report["longest_feature"][1] == 44 and report["shortest_feature"] == ("min_is_ios_l1d", 14)


def test_long_and_repeated_names_are_rejected():
    columns = {"x" * 70: {"conditions": [False] * 3, "aggregations": ["COUNT"]}}
    with pytest.raises(ValueError, match="80 characters"):
        FeatureSpec.from_dict(login_config(col_agg_dict=columns))
    with pytest.raises(ValueError, match="two features are named count_login_id_l1d"):
        FeatureSpec.from_dict(login_config(time_cond_dict=["l1d", "l1d"]))


def test_conditions_are_looked_up_in_all_lists():
    config = login_config(
        condition_name_0=["big"],
        condition_name_1=["TRUE", {"big": "login_id > 5"}],
        col_agg_dict={"login_id": {"conditions": [True, False, False], "aggregations": ["COUNT"]}},
    )
    assert FeatureSpec.from_dict(config).features()[0].conditions[0].sql == "login_id > 5"


def test_unknown_aggregation_and_false_window_flag_are_rejected():
    with pytest.raises(ValueError, match="unknown aggregations"):
        FeatureSpec.from_dict(login_config(col_agg_dict={"a": {"conditions": [True], "aggregations": ["SUM"]}}))
    with pytest.raises(ValueError, match="always apply"):
        FeatureSpec.from_dict(
            login_config(col_agg_dict={"a": {"conditions": [True, False, False, False], "aggregations": ["MIN"]}})
        )


def test_three_condition_lists_cross():
    config = login_config(
        condition_name_1=["TRUE", {"big": "login_id > 5"}],
        col_agg_dict={"login_id": {"conditions": [True, True, False, True], "aggregations": ["COUNT"]}},
        time_cond_dict=["l7d"],
    )
    features = FeatureSpec.from_dict(config).features()
    assert [f.name for f in features][:3] == [
        "count_login_id_l7d",
        "count_big_login_id_l7d",
        "count_is_ios_login_id_l7d",
    ]
    assert features[3].description == "count login_id where is_ios and big last 7 days"


def test_windows():
    assert describe_window("l1h") == "last 1 hour" and describe_window("l2w") == "last 2 weeks"
    assert describe_window("recent") == "recent"
    assert window_millis("l2w") == 14 * 86_400_000
    assert window_months("l2y") == 24 and window_months("l3m") == 3 and window_months("l3d") is None
    with pytest.raises(ValueError):
        window_millis("l1m")


def test_catalogue(spark, tmp_path):
    spec = FeatureSpec.from_dict(login_config())
    df = catalogue(spark, spec, created_ms=5)
    assert df.schema == CATALOGUE_SCHEMA and df.count() == 189
    row = df.filter("feature_name = 'login_hist_v1:count_is_ios_login_id_l7d'").first()
    assert row["description"] == "count login_id where is_ios last 7 days"
    assert row["entities_mapping"] == {} and row["status"] == "CREATED"
    assert row["feature_data_type"] == "float" and row["created_time"] == row["updated_time"] == 5
    path = write_json(df, str(tmp_path / "catalogue"))
    assert sorted(spark.read.schema(CATALOGUE_SCHEMA).json(path).collect()) == sorted(df.collect())


def test_yaml_files(tmp_path):
    yaml = pytest.importorskip("yaml")
    path = tmp_path / "features.yaml"
    path.write_text(yaml.safe_dump(login_config()))
    assert FeatureSpec.from_yaml(str(path)) == FeatureSpec.from_dict(login_config())
    path = tmp_path / "run.yaml"
    path.write_text("ID_COLUMNS: [id]\nTARGET_COL: y\nDATE_COL: d\nTRAIN_START_DATE: '2024-01-01'\n")
    spec = PipelineSpec.from_yaml(str(path))
    assert spec == PipelineSpec(("id",), "y", "d", "2024-01-01") and spec.oot_start is None
    assert spec.features(["f2", "y", "id", "f1", "d"]) == ["f2", "f1"]
