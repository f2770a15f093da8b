"""The operators on vectors, sketches and conversations against brute force, with odd inputs."""
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import centroids, hyperminhash, queries
from riskframe.llm import conversation_repair as cr

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------------------ op11
def brute_clusters(rows, dims, k, rounds, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [list(v) for _, v in seeds]
    far = lambda v, w: sum((a - b) ** 2 for a, b in zip(v, w))
    near = lambda v: min((far(v, w), j) for j, w in enumerate(c))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(c)):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    got = [(i, *near(v)) for i, v in kept]
    total = {j: sum(d for _, d, o in got if o == j) for j in range(len(c))}
    return sorted(((i, o, d, total[o], sum(total.values()), hashlib.sha256(",".join(map(str, c[o])).encode()).hexdigest())
                   for i, d, o in got), key=str)


def vectors(spark, n, dims, seed):
    r = random.Random(seed)
    rows = [(i, [r.choice([-1.5, -0.51, 0.0, 0.25, 1.0, r.random()]) for _ in range(dims)]) for i in range(n)]
    rows += [rows[0], (3, rows[7][1]), (None, rows[1][1]), (None, rows[2][1]), (900, None), (901, [None] * dims),
             (902, [0.5] * (dims - 1)), (903, [0.5] * (dims + 1)), (904, [math.nan] * dims),
             (905, [math.inf] + [0.0] * (dims - 1)), (906, [])]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {"cluster": F.lit("clash"), "label": F.col("vec_id") % 3}).repartition(3)


@pytest.mark.parametrize("n, dims, k", [(60, 4, 5), (40, 2, 16), (3, 4, 16)])
def test_clusters_equal_brute_force(spark, n, dims, k):
    rows, df = vectors(spark, max(n, 9), dims, n)
    got = centroids.cluster(df, dims=dims, k=k)
    assert got.columns == ["vec_id", "label", *centroids.RESULTS]
    told = [(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got.collect()]
    assert sorted(told, key=str) == brute_clusters(rows, dims, k, 3)


def test_threshold_walk_stops_early_and_is_exact():
    r = np.random.default_rng(2)
    c = r.integers(-1000, 1000, (16, 64))
    x = np.concatenate([c[r.integers(0, 16, 200)] + r.integers(-3, 4, (200, 64)), r.integers(-1000, 1000, (50, 64)), c[:2]])
    x[-1] = (c[3] + c[3]) // 2
    who, far, measured = centroids.nearest(x, c)
    all_far = ((x[:, None] - c) ** 2).sum(2)
    assert (who == all_far.argmin(1)).all() and (far == all_far.min(1)).all()
    low = r.integers(0, 3, (16, 2))                                   # equal centroids, ties
    y = r.integers(-2, 5, (300, 2))
    who, far, measured = centroids.nearest(y, low)
    all_far = ((y[:, None] - low) ** 2).sum(2)
    assert (who == all_far.argmin(1)).all() and (far == all_far.min(1)).all() and measured < y.shape[0] * 16


def test_no_vectors_and_too_far(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert centroids.cluster(empty).collect() == []
    with pytest.raises(Exception, match="does not|has no distance"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")).collect()


# ------------------------------------------------------------------------------ op13
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def brute_edits(tokens):
    """The least (cost, audit) over all edits with up to two inserts in a place."""
    best = None
    places = [(), *[x for n in (1, 2) for x in itertools.product("ua", repeat=n)]]
    for gaps in itertools.product(places, repeat=len(tokens) + 1):
        options = []
        for t in tokens:
            extra = 3 if t != t.lower() else 0
            kept = [("K", extra, t.lower()), ("R", 3 + extra, "u"), ("R", 3 + extra, "a")] if t != "x" else []
            options.append([("D", 4, ""), *kept])
        for edits in itertools.product(*options):
            text, audit, cost = "".join(gaps[0]), "I" * len(gaps[0]), 3 * sum(map(len, gaps))
            for (edit, c, role), more in zip(edits, gaps[1:]):
                text, audit, cost = text + role + "".join(more), audit + edit + "I" * len(more), cost + c
            if (best is None or (cost, audit) < best) and GRAMMAR.match(text):
                best = (cost, audit)
    return best


def test_cheapest_edits_equal_brute_force(monkeypatch):
    r = random.Random(4)
    for size in [0, 1, 2, 3] * 30:
        tokens = "".join(r.choice("suaoSUAOx") for _ in range(size))
        assert cr.chained([cr.parse(tokens)]) == brute_edits(tokens), tokens


def test_parts_of_a_conversation_chain(monkeypatch):
    r = random.Random(5)
    for _ in range(60):
        tokens = "".join(r.choice("suaoSUAOx") for _ in range(r.randrange(70)))
        whole = cr.chained([cr.parse(tokens)])
        cuts = sorted(r.randrange(len(tokens) + 1) for _ in range(3))
        parts = [tokens[a:b] for a, b in zip([0, *cuts], [*cuts, len(tokens)])]
        assert cr.chained([[p for e in cr._STACKS for p in cr.parse(x, e)] for x in parts]) == whole
        with monkeypatch.context() as m:
            m.setattr(cr, "STEP", 5)
            assert cr.chained([cr.parse(tokens)]) == whole


def plain_repair(rows, convs):
    """op13 by its contract, in plain Python; the edits by a table over (rows read, state)."""
    out = {}
    for conv in convs:
        mine = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2], hashlib.sha256(x[3].encode()).digest()))
        count = dict.fromkeys(cr.COUNTS, 0)
        seen, tokens = set(), ""
        for _, turn, role, text in mine:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            t = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not solid:
                count["blank"], t = count["blank"] + 1, "x"
            elif (role, text) in seen:
                count["duplicate"], t = count["duplicate"] + 1, "x"
            elif solid[-1] not in ".!?":
                count["truncated"], t = count["truncated"] + 1, t.upper()
            seen.add((role, text))
            tokens += t
        count["illegal"] = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        turns = [x[1] for x in mine if x[1] is not None]
        count["gaps"] = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        # state: nothing, s, ends with u, ends with a
        step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
        best = {"": (0, "", ())}

        def inserted(b):
            b = dict(b)
            for _ in range(4):
                for s, (c, e, o) in list(b.items()):
                    for y, name in (("u", "user"), ("a", "assistant")):
                        if (s, y) in step:
                            b[step[s, y]] = min(b.get(step[s, y], (1e9, "")), (c + 3, e + "I", (*o, (name, ""))))
            return b
        for token, (_, _, role, text) in zip(tokens, mine):
            new = {}
            for s, (c, e, o) in inserted(best).items():
                for cost, edit, y, name in [(4, "D", None, ""), (0, "K", token.lower(), role), (3, "R", "u", "user"), (3, "R", "a", "assistant")]:
                    if y is None:
                        new[s] = min(new.get(s, (1e9, "")), (c + 4, e + "D", o))
                    elif token != "x" and (s, y) in step:
                        k = step[s, y]
                        cost += 3 if token != token.lower() else 0
                        new[k] = min(new.get(k, (1e9, "")), (c + cost, e + edit, (*o, (name, text))))
            best = new
        cost, audit, kept = min(v for s, v in inserted(best).items() if s in ("", "a"))
        count["cost"] = cost
        out[conv] = (*[count[c] for c in cr.COUNTS], audit, hashlib.sha256("\n".join(f"{a}:{b}" for a, b in kept).encode()).hexdigest())
    return out


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        sp = lambda x: " " if x is None else str(x)
        how = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = "user" if how == 4 else sp(role), sp(text)
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(how, 1)
    return out


def odd_conversations():
    r = random.Random(8)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(r.randrange(1, 9)):
            rows.append((conv, r.choice([turn, turn, turn, None, turn * 2]), r.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]),
                         r.choice(["Fine.", "What?", "no end", None, "", " \n\t", "é!", "a.\n", "x" * 50_000 + ".", "? "])))
    rows += [rows[0], rows[1], rows[1]]
    rows += [(77, t, ["user", "assistant"][t % 2], f"Text {t % 50}.") for t in range(700)]      # one long conversation
    drop = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(drop, 0, "user", "Gone.")]


def test_repair_equals_the_contract(spark):
    rows = odd_conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("cost", F.lit("clash"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # several tasks share the long conversation
    got = cr.repair(cr.damage(df.repartition(5)))
    told = {r.conv: tuple(r)[1:] for r in got.collect()}
    assert cr._parts(cr.damage(df)).where("conv = 77").count() > 1
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got.columns == ["conv", *cr.COUNTS, "audit", "repaired_sha256"]
    want = plain_repair(damaged(rows), {x[0] for x in rows})
    assert told == want
    kept = cr.repaired_rows(cr.damage(df)).orderBy("conv", "position").collect()
    texts = {}
    for r in kept:
        texts.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    for conv, w in want.items():
        assert hashlib.sha256("\n".join(texts.get(conv, [])).encode()).hexdigest() == w[-1]
    assert cr.repair(cr.damage(df.limit(0))).collect() == []


def test_repair_query_equals_the_contract(spark):
    rows = [tuple(r) for r in queries.table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in queries.op13(spark, SF).collect()}
    assert got == plain_repair(damaged(rows), {x[0] for x in rows})


# ------------------------------------------------------------------------------ op12
def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows, percent):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(((d, len(s), least.get(top(i)), d == least.get(top(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def copies(seed):
    """Families of edited copies around the threshold, small sets, one family beyond a block, odd rows."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(5000)}"
    texts = []
    for size, many, edits in [(6, 4, 1), (7, 5, 1), (11, 6, 1), (30, 8, 1), (60, 8, 2), (120, 40, 3), (120, 30, 2), (400, 8, 8), (400, 8, 12)]:
        origin = [word() for _ in range(size)]
        texts.append(origin)
        for _ in range(many):
            copy = list(origin)
            for _ in range(r.randrange(edits + 1)):
                copy[r.randrange(size)] = word()
            texts.append(copy if r.random() < 0.7 else copy[r.randrange(2):])
    texts += [[word() for _ in range(r.randrange(1, 80))] for _ in range(40)]
    common = [word() for _ in range(20)]
    texts += [common + [word() for _ in range(r.randrange(15))] for _ in range(40)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "A b"), (904, "a  B"), (905, "a"), rows[0], rows[3], (None, rows[0][1]), (None, "alone here now"),
             (None, "alone here now"), (None, None), (2, "an id twice, quite another text, of more words")]
    return rows


@pytest.mark.parametrize("seed, percent, block", [(1, 85, 512), (2, 85, 4), (3, 75, 8)])
def test_near_copies_equal_brute_force(spark, monkeypatch, seed, percent, block):
    monkeypatch.setattr(hyperminhash, "BLOCK", block)
    rows = copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"root": F.lit("mine"), "KEPT": F.lit("clash")}).repartition(4)
    got = hyperminhash.near_copies(df, percent=percent)
    assert got.columns == ["doc_id", "root", *hyperminhash.RESULTS]
    told = sorted(((r.doc_id, r.n_shingles, r.component_id, bool(r.doc_id == r.component_id and r.doc_id is not None)) for r in got.collect()), key=str)
    want = sorted(((d, n, c, d == c and d is not None) for d, n, c, _ in brute_components(rows, percent)), key=str)
    # words without an id and without words are components of their own
    assert [x for x in told if x[0] is not None] == [(d, n, c if n else d, (c if n else d) == d) for d, n, c, _ in want if d is not None]
    assert [x[:3] for x in told if x[0] is None] == [x[:3] for x in want if x[0] is None]


def test_near_copies_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert hyperminhash.near_copies(empty).collect() == []
    none = spark.createDataFrame([(1, None), (1, ""), (None, " ")], "doc_id long, text string")
    assert sorted(map(tuple, hyperminhash.near_copies(none).collect()), key=str) == [(1, 0, 1, True), (1, 0, 1, True), (None, 0, None, True)]


def test_registers_estimate_similarity():
    r = np.random.default_rng(3)
    for n, common in [(1000, 900), (1000, 500), (20_000, 18_000), (300, 0), (20_000, 0)]:
        h = hyperminhash.mix(r.integers(1, 1 << 62, 2 * n - common).astype(np.uint64))
        a, b = h[:n], h[n - common:]
        reg = hyperminhash.registers(np.concatenate([a, b]), np.repeat([0, 1], [n, n]), 2)
        filled = np.array([((reg[0] | reg[1]) > 0).sum()])
        size = np.array([n])
        est, may = hyperminhash.allowed(np.array([((reg[0] == reg[1]) & (reg[0] > 0)).sum()]), filled, size, size, 85)
        true = common / (2 * n - common)
        assert abs(est[0] - true) < 0.16 and (may[0] or true < 0.85)
    one = hyperminhash.registers(np.zeros(0, np.uint64), np.zeros(0, np.int64), 1)
    assert not one.any() and not hyperminhash.band_keys(one).any()


def test_url_rules_fit_whole_hosts(spark):
    """A host that ends with a line feed is another host."""
    from riskframe.llm import url_templates
    df = spark.createDataFrame([("http://example.com/en/a",), ("http://example.com\n/en/a",), ("http://a.example.com/en/a",)], "url string")
    rule, _ = url_templates.rule_of(url_templates.host_of(F.col("url")), url_templates.path_of(F.col("url")))
    assert [r.rule for r in df.select(rule.alias("rule")).collect()] == ["example.com/en/", None, "example.com/en/"]
