import pytest

from symcube.functions.naming import check_names, hidden_names, key_names, stored_field, value_name
from symcube.functions.ordinals import in_set, restrict
from symcube.operators.scan import resolve_threads


@pytest.mark.parametrize(
    ("domains", "reserved", "expected"),
    [
        (["crew", "ship", "port"], {"value"}, ["crew", "ship", "port"]),
        (["day", "day", "day"], set(), ["day", "day_1", "day_2"]),
        (["level", "*"], {"level", "dim_1"}, ["level_0", "dim_1_1"]),
        (["b_1", "b", "b_1"], {"b"}, ["b_1", "b_1_1", "b_1_2"]),
        (["", "*", "*"], set(), ["dim_0", "dim_1", "dim_2"]),
        (["x_3", "dim_2", "*", "x", "x"], {"x"}, ["x_3", "dim_2", "dim_2_2", "x_3_3", "x_4"]),
        ([], {"value"}, []),
    ],
)
def test_key_names(domains, reserved, expected):
    assert key_names(domains, reserved) == expected


def test_value_names():
    assert value_name("Parameter") == value_name("Set", "marginal") == value_name("Alias", "scale") == "value"
    assert value_name("Variable") == value_name("Equation") == "level"
    assert value_name("Variable", "upper") == stored_field("Variable", "upper") == "upper"
    assert stored_field("Parameter", "upper") == "level"
    for bad in ("Level", "", "nope"):
        with pytest.raises(ValueError):
            value_name("Variable", bad)


def test_colliding_names_are_rejected():
    check_names(["a", "b"], "value")
    for keys in (["a", "a"], ["value", "b"]):
        with pytest.raises(ValueError):
            check_names(keys, "value")
    check_names(["I", "i"], "value")
    for keys in (["I", "i"], ["Value", "b"]):
        with pytest.raises(ValueError, match="case"):
            check_names(keys, "value", case_sensitive=False)


def test_hidden_names_avoid_visible_ones():
    assert hidden_names(2, ["a", "b"]) == (["_u0", "_u1"], "_at")
    assert hidden_names(1, ["_U0", "__at"]) == (["___u0"], "___at")


def test_threads():
    assert resolve_threads(None, 10**9, 8) == resolve_threads(0, 1, 8) == resolve_threads(1, 1, 8) == 1
    assert resolve_threads("auto", 4_999_999, 8) == 1 and resolve_threads("auto", 5_000_000, 8) == 8
    assert resolve_threads(5, 1, 8) == 5
    for bad in ("many", -1, 2.5, True):
        with pytest.raises(ValueError):
            resolve_threads(bad, 1, 8)


def test_in_set(spark):
    from pyspark.sql import functions as F

    df = spark.range(100)
    for ids in ([], [5], [1, 2, 3], [1, 2, 9, 40, 41, 42, 43, 99], list(range(0, 100, 7)), [3, 3, 4]):
        assert sorted(r.id for r in df.where(in_set(F.col("id"), ids)).collect()) == sorted(set(ids))
        assert sorted(r.id for r in restrict(df, "id", ids, most=3).collect()) == sorted(set(ids))
