import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ledgerlens.operators import boosting
from ledgerlens.operators.boosting import BINS, LEAF, LEVEL, MISSING, BoostedTrees, Rules

RULES = {
    LEVEL: Rules(LEVEL, max_depth=3),
    LEAF: Rules(LEAF, max_leaves=9, least_hessian=1e-3, least_rows=5),
}


def table(n=600, seed=4):
    draw = np.random.default_rng(seed)
    bins = draw.integers(0, 12, (n, 4)).astype(np.uint8)
    bins[draw.random((n, 4)) < 0.1] = MISSING
    label = ((bins[:, 0] < 5) ^ (bins[:, 2] > 7) | (bins[:, 3] == MISSING)).astype(float)
    label = np.where(draw.random(n) < 0.1, 1 - label, label)
    return bins, label, np.where(label > 0, 3.0, 1.0)


def plain_tree(bins, g, h, rules, rate):
    """Greedy growth over lists of rows, each candidate summed by itself."""

    def value(rows):
        return -g[rows].sum() / (h[rows].sum() + rules.l2) * rate

    def best(rows):
        def part(r):
            return g[r].sum() ** 2 / (h[r].sum() + rules.l2)

        found = (boosting.LEAST_GAIN, None)
        for c in range(bins.shape[1]):
            b = bins[rows, c]
            for cut in range(BINS - 2):
                for missing_left in (False, True):
                    left = np.where(b == MISSING, missing_left, b <= cut)
                    sides = rows[left], rows[~left]
                    if any(len(s) < rules.least_rows or h[s].sum() < rules.least_hessian or not len(s) for s in sides):
                        continue
                    gain = part(sides[0]) + part(sides[1]) - part(rows)
                    if gain > found[0] + 1e-9:
                        found = gain, (c, cut, missing_left, *sides)
        return found

    leaves = [(0, np.arange(len(bins)))]
    splits, out = [], np.zeros(len(bins))
    gains = {}
    while len(leaves) < (rules.max_leaves if rules.growth == LEAF else 10**9):
        for i, (depth, rows) in enumerate(leaves):
            key = rows.tobytes()
            if key not in gains:
                gains[key] = best(rows)
        open_ = [
            (gains[r.tobytes()][0], -i) for i, (d, r) in enumerate(leaves)
            if gains[r.tobytes()][1] and (rules.growth == LEAF or d < rules.max_depth)
        ]
        if not open_:
            break
        i = -max(open_)[1]
        depth, rows = leaves.pop(i)
        c, cut, missing_left, a, b = gains[rows.tobytes()][1]
        splits.append((c, cut, missing_left, len(rows)))
        leaves += [(depth + 1, a), (depth + 1, b)]
    for _, rows in leaves:
        out[rows] = value(rows)
    return sorted(splits), out


def splits_of(tree, bins):
    """(column, cut, missing left, rows) of each inner node."""
    rows = {0: np.arange(len(bins))}
    out = []
    for node in range(len(tree.column)):
        if tree.left[node] >= 0:
            at = rows[node]
            b = bins[at, tree.column[node]]
            left = np.where(b == MISSING, tree.missing_left[node], b <= tree.cut[node])
            rows[tree.left[node]], rows[tree.right[node]] = at[left], at[~left]
            out.append((tree.column[node], tree.cut[node], tree.missing_left[node], len(at)))
    return sorted(out)


def local_passes(bins, g, h, asked):
    def histograms(tree, nodes):
        asked.append(len(nodes))
        slot = np.full(len(tree.column), -1)
        slot[nodes] = np.arange(len(nodes))
        sums = boosting.cell_sums(bins, slot[tree.leaves_of(bins)], g, h, len(nodes))
        return {n: sums[:, i] for i, n in enumerate(nodes)}

    return histograms


def depth_of(tree, node=0):
    return 0 if tree.left[node] < 0 else 1 + max(depth_of(tree, c) for c in (tree.left[node], tree.right[node]))


@pytest.mark.parametrize("growth", [LEVEL, LEAF])
def test_a_tree_equals_plain_growth(growth):
    bins, label, weight = table()
    g, h = boosting.slopes(np.zeros(len(label)), label, weight)
    asked = []
    tree = boosting.grow(local_passes(bins, g, h, asked), RULES[growth], 0.1)
    want, values = plain_tree(bins, g, h, RULES[growth], 0.1)
    assert splits_of(tree, bins) == want and len(want) > 4
    assert tree.predict(bins) == pytest.approx(values)
    assert len(asked) <= depth_of(tree) + (growth == LEAF)


def test_sums_of_siblings_are_differences():
    bins, label, weight = table(200)
    g, h = boosting.slopes(np.zeros(200), label, weight)
    asked = []
    boosting.grow(local_passes(bins, g, h, asked), Rules(LEVEL, max_depth=3, least_hessian=0.0), 0.1)
    assert asked == [1, 1, 2]  # one of the two, then two of the four nodes


@pytest.fixture(scope="module")
def rows(spark):
    bins, label, weight = table(1500)
    values = np.where(bins == MISSING, np.nan, bins / 3.0)
    data = [(*(float(x) for x in v), float(y), float(w)) for v, y, w in zip(values, label, weight)]
    return spark.createDataFrame(data, "a double, b double, c double, d double, label double, w double").repartition(5)


def estimator(**settings):
    return BoostedTrees(inputCols=list("abcd"), weightCol="w", **settings)


@pytest.mark.parametrize("growth", [LEVEL, LEAF])
def test_rounds_equal_plain_rounds(rows, growth, monkeypatch):
    monkeypatch.setattr(boosting, "STORE_EVERY", 2)
    rules = RULES[growth]
    settings = {"growth": growth, "maxDepth": rules.max_depth, "maxLeaves": rules.max_leaves}
    model = estimator(maxIter=5, minHessian=rules.least_hessian, minRows=rules.least_rows, **settings).fit(rows)
    frame = rows.toPandas()
    bins = boosting.to_bins(frame[list("abcd")].to_numpy(), model.edges)
    y, w = frame["label"].to_numpy(), frame["w"].to_numpy()
    score = np.full(len(frame), np.log(w[y == 1].sum() / w[y == 0].sum()))
    for tree in model.trees:
        g, h = boosting.slopes(score, y, w)
        local = boosting.grow(local_passes(bins, g, h, []), rules, 0.1)
        assert splits_of(tree, bins) == splits_of(local, bins)
        score = score + local.predict(bins)
    got = model.transform(rows).toPandas()
    p = np.array([v[1] for v in got["probability"]])
    assert len(model.trees) == 5
    assert np.sort(p) == pytest.approx(np.sort(1 / (1 + np.exp(-score))))
    assert ((p > 0.5) == (got["prediction"] == 1)).all()


def test_saved_and_loaded(rows, tmp_path):
    fitted = Pipeline(stages=[estimator(maxIter=3)]).fit(rows)
    fitted.write().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    keep = [*"abcd", "prediction", "probability"]
    assert sorted(map(str, fitted.transform(rows).select(*keep).collect())) == sorted(
        map(str, loaded.transform(rows).select(*keep).collect())
    )
    assert loaded.stages[0].getMaxIter() == 3 and loaded.stages[0].rules() == Rules()


def test_ends_when_nothing_gains(spark):
    rows = spark.createDataFrame([(1.0, 1.0)] * 5 + [(1.0, 0.0)] * 5, "a double, label double")
    model = BoostedTrees(inputCols=["a"], maxIter=50).fit(rows)
    assert model.trees == [] and model.transform(rows).where("prediction > 0").isEmpty()
    none = BoostedTrees(inputCols=["a"]).fit(rows.limit(0))
    assert none.trees == [] and none.transform(rows.withColumn("a", F.lit(None).cast("double"))).count() == 10


def test_penalty_keeps_precision_over_rounds(spark):
    """Few positives of great weight: more rounds do not ruin the order of held-out rows."""
    draw = np.random.default_rng(7)
    x = draw.normal(size=(4000, 3))
    y = ((x[:, 0] + 0.5 * x[:, 1] > 2.4) ^ (draw.random(4000) < 0.002)).astype(float)
    data = [(*(float(v) for v in r), float(t), 400.0 if t else 1.0) for r, t in zip(x, y)]
    rows = spark.createDataFrame(data, "a double, b double, c double, label double, w double")
    train, test = rows.where("c < 0.3"), rows.where("c >= 0.3")

    def precision(rounds):
        model = BoostedTrees(
            inputCols=list("abc"), weightCol="w", growth=LEAF, minRows=20, minHessian=1e-3, maxIter=rounds
        ).fit(train)
        p = [(r.probability[1], r.label) for r in model.transform(test).select("probability", "label").collect()]
        ranked = [label for _, label in sorted(p, reverse=True)]
        hits = np.cumsum(ranked)
        return sum(h / (i + 1) for i, (h, label) in enumerate(zip(hits, ranked)) if label) / hits[-1]

    few, many = precision(4), precision(20)
    assert few > 0.3 and many > few - 0.1


def test_copies_are_kept_once_with_their_number(rows):
    packed = boosting.binned(rows, list("abcd"), boosting.edges_of(rows, list("abcd")), "label", "w", 0.0)
    once, many = boosting.blocks_of(packed, 4), boosting.blocks_of(packed.unionByName(packed).unionByName(packed), 4)

    def facts(blocks):
        found = blocks.collect()
        return [sum(len(b[0]) for b in found), *(sum(b[k].sum() for b in found) for k in (2, 3))]

    kinds, weight, n = facts(once)
    assert n == 1500 and kinds <= 1500 and facts(many) == [kinds, 3 * weight, 4500]
    a, b = (boosting._pass(x, 4, boosting.Tree(), [0])[0] for x in (once, many))
    assert b == pytest.approx(3 * a)
    for x in (once, many):
        x.unpersist()


def test_a_pass_is_one_job(spark, rows):
    """A round of depth 3 takes three passes; what comes before the rounds is not many jobs."""
    context = spark.sparkContext

    def jobs(rounds):
        context.setJobGroup(f"boost-{rounds}", "")
        assert len(estimator(maxIter=rounds, maxDepth=3, minRows=20).fit(rows).trees) == rounds
        context.setLocalProperty("spark.jobGroup.id", None)
        return len(context.statusTracker().getJobIdsForGroup(f"boost-{rounds}"))

    assert jobs(7) - jobs(2) <= 5 * 3


def test_tasks_follow_the_rows():
    assert boosting.tasks_for(0, 8) == 1 and boosting.tasks_for(10**5, 8) == 8
    assert boosting.tasks_for(10**8, 8) == -(-(10**8) // boosting.TASK_ROWS)


def test_a_round_like_the_last_takes_one_pass():
    """Sums ahead change no tree, and are left off while trees differ."""
    bins, label, weight = table()
    g, h = boosting.slopes(np.zeros(len(label)), label, weight)
    other = np.random.default_rng(1).normal(size=len(g))
    asked = []

    def sums(g):
        def of(tree, nodes):
            asked.append(len(nodes))
            out = {}
            for n in nodes:  # asked nodes may lie above each other
                at = next((rows[node == n] for rows, node in tree.walk(bins) if (node == n).any()), np.zeros(0, int))
                out[n] = boosting.cell_sums(bins[at], np.zeros(len(at), int), g[at], h[at], 1)[:, 0]
            return out

        return of

    for growth in (LEVEL, LEAF):
        ahead, passes = boosting._Ahead(), []
        for x in (g, 0.9 * g, 0.8 * g, other, g, g, g):
            asked.clear()
            tree = boosting.grow(ahead.histograms(sums(x)), RULES[growth], 0.1)
            passes.append(len(asked))
            alone = boosting.grow(local_passes(bins, x, h, []), RULES[growth], 0.1)
            assert tree._lists()[:5] == alone._lists()[:5] and tree.value == pytest.approx(alone.value)
        assert passes[0] > 2 and passes[1] > 2 and passes[2] == 1
        assert passes[3] > 1 and passes[4] > 2 and passes[-1] == 1


def test_a_pass_sums_nodes_above_each_other(spark):
    bins, label, weight = table(300)
    tree = boosting.Tree()
    low, high = tree.split(0, 0, 5, True)
    tree.split(low, 2, 6, False)
    score, one = np.zeros(300), np.ones(300)
    blocks = spark.sparkContext.parallelize([(bins[a:b], label[a:b], weight[a:b], one[a:b], score[a:b]) for a, b in ((0, 90), (90, 300))], 2)
    found = boosting._pass(blocks, 4, tree, [0, low, high, 3])
    left = (bins[:, 0] <= 5) | (bins[:, 0] == MISSING)
    assert found[0] == pytest.approx(found[low] + found[high])
    assert found[low][2, 1].sum() == left.sum() and found[3][2, 0].sum() == (left & (bins[:, 2] <= 6)).sum()


def test_rows_are_walked_again_only_after_other_splits(rows, monkeypatch):
    """Rounds with the splits of the last add their values per node; cached rows stay as they are."""
    made, real = [], boosting._rescored
    monkeypatch.setattr(boosting, "_rescored", lambda *a: made.append(a[3].shape()) or real(*a))
    model = estimator(maxIter=12, maxDepth=2, stepSize=0.01).fit(rows)
    shapes = [t.shape() for t in model.trees]
    assert len(shapes) == 12 and len(made) == sum(a != b for a, b in zip([None, *shapes], shapes)) < 12


def test_a_pass_goes_on_from_known_nodes(spark):
    bins, label, weight = table(300)
    walked, tree = boosting.Tree(), boosting.Tree()
    low, high = walked.split(0, 0, 5, True)
    walked.split(low, 2, 6, False)
    tree.split(0, 0, 5, True)
    tree.split(high, 1, 4, False)  # the left side is coarser than what was walked, the right one finer
    node, worth = walked.leaves_of(bins), np.array([0.0, 0.0, 0.7, -0.2, 0.4])
    blocks = spark.sparkContext.parallelize([(bins, label, weight, np.ones(300), np.zeros(300), node)], 1)
    there = tree.leaves_of(bins)
    g, h = boosting.slopes(worth[node], label, weight)
    for nodes in ([0, low, 3], [3], [4, 0]):
        found = boosting._pass(blocks, 4, tree, nodes, walked, worth)
        for n in nodes:
            at = np.isin(there, {0: [1, 3, 4], low: [1], 3: [3], 4: [4]}[n])
            assert found[n] == pytest.approx(boosting.cell_sums(bins, np.where(at, 0, -1), g, h, 1)[:, 0])
    assert walked.finer(walked) and not walked.finer(tree)
    ((*_, score, moved),) = boosting._rescored(blocks, walked, worth, tree).collect()
    assert score == pytest.approx(worth[node]) and (moved == there).all()


def test_fits_of_the_same_rows_are_prepared_for_once(rows, monkeypatch):
    made, real = [], boosting.blocks_of
    monkeypatch.setattr(boosting, "blocks_of", lambda *a: made.append(1) or real(*a))
    share = boosting.Share()
    try:
        for growth, weight in ((LEVEL, "w"), (LEAF, "w"), (LEVEL, "v")):
            one = BoostedTrees(inputCols=list("abcd"), weightCol=weight, growth=growth, maxIter=3)
            one.share = share
            data = rows.withColumn("v", F.col("w") * 2)
            alone = BoostedTrees(inputCols=list("abcd"), weightCol=weight, growth=growth, maxIter=3).fit(data)
            assert [t.shape() for t in one.fit(data).trees] == [t.shape() for t in alone.trees]
    finally:
        share.close()
    assert len(made) == 3 + 2
