import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from voxspark.functions.filters import compile_filter, parse_filter

ROWS = [(i, n, t) for i, (n, t) in enumerate(
    (n, t) for n in (None, 1.0, 2.0, 3.0, 4.0) for t in (None, "a", "b", "c")
)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "id int, n double, t string").cache()


def holds(spec, row) -> bool:
    """Two-valued reading of a filter document."""

    def field(value, cond):
        if not isinstance(cond, dict):
            cond = {"$eq": cond}
        return all(leaf(value, op, v) for op, v in cond.items())

    def leaf(value, op, v):
        if op == "$not":
            return not field(value, v)
        if op == "$neq":
            return not leaf(value, "$eq", v)
        if op == "$nin":
            return not leaf(value, "$in", v)
        if value is None:
            return False
        return {
            "$eq": lambda: value == v, "$gt": lambda: value > v, "$lt": lambda: value < v,
            "$gte": lambda: value >= v, "$lte": lambda: value <= v, "$in": lambda: value in v,
        }[op]()

    def doc(s):
        out = True
        for key, cond in s.items():
            if key == "$and":
                ok = all(doc(x) for x in cond)
            elif key == "$or":
                ok = any(doc(x) for x in cond)
            elif key == "$not":
                ok = not doc(cond)
            else:
                ok = field({"n": row[1], "t": row[2]}[key], cond)
            out = out and ok
        return out

    return doc(spec)


numbers = st.sampled_from([0.0, 1.0, 2.0, 3.0, 4.0])
letters = st.sampled_from(["a", "b", "c", "d"])


def conditions(values):
    simple = st.one_of(
        values,
        st.dictionaries(st.sampled_from(["$eq", "$neq", "$gt", "$lt", "$gte", "$lte"]), values, min_size=1, max_size=2),
        st.dictionaries(st.sampled_from(["$in", "$nin"]), st.lists(values, max_size=3), min_size=1, max_size=1),
    )
    return st.one_of(simple, simple.map(lambda c: {"$not": c if isinstance(c, dict) else {"$eq": c}}))


leaves = st.one_of(
    st.fixed_dictionaries({"n": conditions(numbers)}),
    st.fixed_dictionaries({"t": conditions(letters)}),
    st.fixed_dictionaries({"n": conditions(numbers), "t": conditions(letters)}),
)
documents = st.recursive(
    leaves,
    lambda d: st.one_of(
        st.lists(d, min_size=1, max_size=3).map(lambda x: {"$and": x}),
        st.lists(d, min_size=1, max_size=3).map(lambda x: {"$or": x}),
        d.map(lambda x: {"$not": x}),
    ),
    max_leaves=5,
)


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(spec=documents)
def test_filter_matches_plain_evaluation(rows, spec):
    got = sorted(r.id for r in rows.where(compile_filter(spec, rows.schema)).collect())
    assert got == [r[0] for r in ROWS if holds(spec, r)]


def test_empty_filter_keeps_all(rows):
    assert rows.where(compile_filter({}, rows.schema)).count() == len(ROWS)


@pytest.mark.parametrize("spec", [{"x": 1}, {"n": {"$near": 1}}, {"$nor": []}, {"n": {"$gt": "a"}}])
def test_unknown_parts_raise(rows, spec):
    with pytest.raises(ValueError):
        compile_filter(spec, rows.schema)


def test_parse_filter():
    assert parse_filter('{"n": {"$gte": 3}}') == {"n": {"$gte": 3}}
    assert parse_filter("{broken") == {}
    assert parse_filter("[1]") == {}
    assert parse_filter(None) == {}


def test_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(ROWS, "id int, n double, t string").write.parquet(path)
    df = spark.read.parquet(path)
    spec = {"n": {"$gte": 2}, "$not": {"t": "a"}}
    plan = df.where(compile_filter(spec, df.schema))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(n,2" in plan
    assert "Or(Not(EqualTo(t,a)),IsNull(t))" in plan
