"""Small tests of the training-data operators against brute force, with odd inputs."""
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import (decontamination, jaccard_join, language, line_quality, mixing, queries, reply_trees,
                           sentence_spans, suffix_dedup, token_records, url_templates)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, n_hit string"


def sample(spark, n=24, seed=3):
    """Random texts, exact and near copies, null, empty, wordless, repeated rows, a clashing column."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeé") for _ in range(r.randrange(1, 6))) for _ in range(60)]
    texts = [" ".join(r.choice(vocab) for _ in range(r.randrange(1, 160))) + "." for _ in range(n)]
    long = max(texts, key=len)
    w = long.split()
    texts += [long, " ".join(w[:-2]), " ".join(w[2:]), "x " + long, None, "", " \n\t", "one two", "One  two", "!!!"]
    rows = [(i, t, [None, "a", "b"][i % 3], "clash") for i, t in enumerate(texts)]
    rows += [rows[0], (None, "no id here", "a", None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def words(t, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def test_decontamination(spark):
    docs = sample(spark)
    some = [r.text for r in docs.where("doc_id < 3").collect()]
    bench = spark.createDataFrame([(1, some[0]), (2, "one two"), (3, None), (4, ""), (4, some[1]), (5, some[1])], "item_id long, text string")
    one = decontamination.scan(docs, bench)
    assert one.columns.count("n_hit") == 1
    got = sorted(map(str, one.select("doc_id", "n_words", "n_hit", "hit_items", "contaminated").collect()))
    assert got == sorted(map(str, decontamination.scan(docs, bench, max_windows=5).select(
        "doc_id", "n_words", "n_hit", "hit_items", "contaminated").collect()))
    pat, index = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", {}
    for r in bench.collect():
        w = words(r.text, pat)
        for a in range(max(1, len(w) - 12) if w else 0):
            index.setdefault(tuple(w[a:a + 13]), set()).add(str(r.item_id))
    for r in one.collect():
        w, hit, items = words(r.text, pat), set(), set()
        for size in {len(k) for k in index}:
            for a in range(len(w) - size + 1):
                if found := index.get(tuple(w[a:a + size])):
                    items |= found
                    hit |= set(range(a, a + size))
        assert (r.n_words, r.n_hit, r.hit_items) == (len(w), len(hit), sorted(items))
    assert decontamination.scan(docs.limit(0), bench).count() == 0
    assert decontamination.scan(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_remove_spans(spark):
    docs = spark.createDataFrame([(1, "Keep this: é one two, and that.")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "ONE two")], "item_id long, text string")
    assert decontamination.remove_spans(decontamination.scan(docs, bench)).first().text == "Keep this: é , and that."


def test_piece_encoder_equals_the_library():
    from tokenizers import Tokenizer
    path = queries.tokenizer_file()
    enc, lib, r = token_records.PieceEncoder(path), Tokenizer.from_file(path), random.Random(5)
    texts = ["", "it's  a\n\n test 's ''s don't  ", "'strong 'RE're 've'll 'd'm", "日本語 １２３ ½ ² x²", "🙂🙂 ok's🙂's", "<|endoftext|> a"]
    texts += ["".join(r.choice(" \n\t'stmdrevl aé1!日²\u200b\r\xa0\u3000") for _ in range(r.randrange(40))) for _ in range(2000)]
    for group in (texts[:5] + texts[6:], texts):
        raw = [t.encode() for t in group]
        off = np.append(0, np.cumsum([len(b) for b in raw])).astype(np.int64)
        ids, size = enc.encode(np.frombuffer(b"".join(raw), np.uint8), off)
        cut = np.append(0, np.cumsum(size))
        assert [ids[a:b].tolist() for a, b in zip(cut, cut[1:])] == [e.ids for e in lib.encode_batch(group, add_special_tokens=False)]


def test_records_round_trip(spark):
    from tokenizers import Tokenizer
    docs, lib = sample(spark), Tokenizer.from_file(queries.tokenizer_file())
    path = token_records.write_records(docs, queries.tokenizer_file(), file_bytes=1000)
    rows = token_records.with_starts(token_records.read_records(spark, path)).orderBy("start").collect()
    want = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    start = 0
    for r, w in zip(rows, want, strict=True):
        ids = lib.encode(w.text or "", add_special_tokens=False).ids + [2]
        assert (r.id, r.start, r.ids, r.ids_crc32) == (w.doc_id, start, ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_records.build_index(spark, token_records.write_records(docs.limit(0), queries.tokenizer_file())).count() == 0


def test_damaged_records_raise():
    with pytest.raises(ValueError):
        list(token_records.parse(b"\x01" * 40))


def test_jaccard_components(spark):
    docs = sample(spark, 30).unionByName(sample(spark, 30, seed=4).withColumn("doc_id", F.col("doc_id") + 1000))
    rows = docs.select("doc_id", "text").collect()
    sets = []
    for r in rows:
        w = words(r.text)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                up[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[top(i)] = min(least.get(top(i), 1 << 60), r.doc_id)
    want = Counter((r.doc_id, len(sets[i]), least.get(top(i))) for i, r in enumerate(rows))
    got = jaccard_join.join_documents(docs)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == want
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len({(x[2]) for x in want})


def test_keep_one_of_each_component(spark):
    """Different texts without an id or under one id all stay, near copies of them go."""
    r = random.Random(7)
    a, b, c, d, e = ([f"w{r.randrange(10 ** 6)}" for _ in range(60)] for _ in range(5))
    rows = [(None, a), (None, b), (None, b[1:]), (None, b), (5, c), (5, d), (5, d), (None, d), (6, d[1:]), (7, d), (8, e), (8, e[1:]),
            (None, []), (None, []), (9, []), (9, []), (10, [])]
    docs = spark.createDataFrame([(i, " ".join(t), "s", None) for i, t in rows], SCHEMA)
    kept = [(x.doc_id, x.text.split()) for x in jaccard_join.keep_one(docs).collect()]
    assert len(kept) == 9 and all(k in rows for k in kept)
    for want in ((None, a), (5, c), (5, d), (9, []), (10, [])):
        assert kept.count(want) == 1
    assert kept.count((None, [])) == 2 and sum(k in ((None, b), (None, b[1:])) for k in kept) == 1
    assert sum(k in ((8, e), (8, e[1:])) for k in kept) == 1


def test_suffix_dedup(spark, monkeypatch):
    docs = sample(spark)
    rows, size = docs.collect(), 70
    seen = Counter((r.text or "").encode()[i:i + size] for r in rows for i in range(len((r.text or "").encode()) - size + 1))
    want = Counter()
    for r in rows:
        b = (r.text or "").encode()
        gone = {i + k for i in range(len(b) - size + 1) if seen[b[i:i + size]] > 1 for k in range(size)}
        spans = sum(1 for i in gone if i - 1 not in gone)
        want[(r.doc_id, len(b), len(gone), spans, bytes(x for i, x in enumerate(b) if i not in gone))] += 1
    for pieces in (suffix_dedup.SHARD_PIECES, 2):
        monkeypatch.setattr(suffix_dedup, "SHARD_PIECES", pieces)
        got = suffix_dedup.dedup(docs, length=size).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == want
    assert suffix_dedup.dedup(docs.limit(0)).count() == 0


def test_sentence_spans(spark):
    a = "The first sentence has five words. A second one is here now. And a third closes it off. "
    rows = [(1, "Alone here. " + a + "End one."), (2, "Other start. " + a + "End two."), (3, "Nothing shared at all in this."), (4, None), (5, "")]
    got = {r.doc_id: r for r in sentence_spans.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0 and got[1].clean_text == rows[0][1]
    assert got[2].n_removed >= 3 and "second one is here" not in got[2].clean_text and got[2].clean_text.startswith("Other start.")
    assert got[3].n_removed == 0 and got[4].clean_text is None and got[5].clean_text == ""


def test_sentence_spans_with_a_full_bitmap(spark, monkeypatch):
    """The bitmap of repeated hashes spares exchanges only; an empty table marks nothing."""
    r = random.Random(3)
    shared = [" ".join(f"s{r.randrange(900)}" for _ in range(20)) + "." for _ in range(30)]
    docs = spark.createDataFrame([(i, " ".join(f"w{r.randrange(10**6)}" for _ in range(40)) + ". " + r.choice(shared)) for i in range(300)], "doc_id long, text string")
    want = sorted((x.doc_id, x.n_removed, x.clean_text) for x in sentence_spans.dedup(docs).collect())
    assert any(n for _, n, _ in want)
    empty = sentence_spans.dedup(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "n_sentences", "n_removed", "clean_text"]
    monkeypatch.setattr(sentence_spans, "_repeats", lambda hashes: np.full(4096, 255, np.uint8))
    assert want == sorted((x.doc_id, x.n_removed, x.clean_text) for x in sentence_spans.dedup(docs).collect())


@pytest.mark.parametrize("kind", ["one-word sentences", "no stops", "low vocabulary", "long sentences", "odd sentences"])
def test_sentence_spans_in_any_text(spark, kind):
    """A repeat of 51 words at any offset holds a span, a whole repeat goes, and what goes stands elsewhere."""
    r = random.Random(11)
    vocab = [f"w{i}" for i in range(3 if kind == "low vocabulary" else 5000)]

    def text(n):
        w = [r.choice(vocab) for _ in range(n)]
        stop = {"one-word sentences": 1.0, "long sentences": 0.03, "odd sentences": 0.2}.get(kind, 0.0)
        return [x + "!!" if r.random() < stop else x for x in w]
    rows, shared = [], [text(51) for _ in range(40)]
    for i, p in enumerate(shared):
        rows += [(2 * i, " ".join(text(r.randrange(40)) + p + text(r.randrange(40)))),
                 (2 * i + 1, " ".join(text(r.randrange(40)) + p + text(r.randrange(40))))]
    short = " ".join(text(14)) + "."
    rows += [(500, " ".join(text(30)) + ". " + short + " " + " ".join(text(30))), (501, short), (502, short + " \n")]
    rows += [(600 + k, " ".join(text(20) + ["Word!!"] * 60)) for k in range(2)] + [(700, rows[0][1])]
    got = {x.doc_id: x for x in sentence_spans.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(40):
        assert got[2 * i + 1].n_removed > 0
        assert len(words(rows[2 * i + 1][1])) - len(words(got[2 * i + 1].clean_text)) >= 26
    assert not words(got[501].clean_text) and not words(got[502].clean_text) and not words(got[700].clean_text)
    assert got[600].clean_text.count("Word!!") >= 12 > got[601].clean_text.count("Word!!")
    if kind != "low vocabulary":
        assert all(got[2 * i].n_removed == 0 for i in range(40)) and got[500].clean_text == dict(rows)[500]
        assert all(set(words(" ".join(shared[i]))) >= set(words(rows[2 * i + 1][1])) - set(words(got[2 * i + 1].clean_text)) for i in range(40))


def test_mixing(spark):
    docs = sample(spark, 60)
    a, b = (mixing.allocate(docs, bucket_rows=k) for k in (5, 1000))
    cols = ["doc_id", "size", "source_size", "copies", "taken"]
    assert Counter(map(tuple, a.select(cols).collect())) == Counter(map(tuple, b.select(cols).collect()))
    rows = a.collect()
    total = sum(len(words(r.text)) for r in docs.collect())
    targets = {r.source: (r.target, r.source_size) for r in rows}
    assert abs(sum(t for t, _ in targets.values()) - total) < 1e-6
    assert all(t <= 3 * s + 1e-9 for t, s in targets.values()) and all(0 <= r.copies <= 3 for r in rows)
    assert mixing.emit(a).count() == sum(r.copies for r in rows)
    assert mixing.allocate(docs.limit(0)).count() == 0


def test_line_quality(spark):
    docs = sample(spark).unionByName(spark.createDataFrame(
        [(100, "buy $$$ now *** " * 40, "a", None), (101, "a b c d e f g h i j\n" * 9, "a", None)], SCHEMA))
    for r in line_quality.judge(docs).collect():
        t = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        c = Counter(zip(w, w[1:], w[2:]))
        cover = {i + k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (
            len(w), sum(map(len, w)), len(cover), len(lines) - len(set(lines)))
        assert r.n_symbols == sum(x in "#*$%&|<>" for x in t)
        assert r.base_failed == (len(w) < 50 or 100 * len(cover) > 50 * len(w)) and (r.kept is False or not r.base_failed)
    assert line_quality.judge(docs.limit(0)).count() == 0


def test_reply_trees(spark):
    nodes = spark.createDataFrame([
        (1, 1, None, "user", "hi ## :x \\", 0.0), (1, 2, 1, "assistant", "a</turn>\n### user: b###", 0.2), (1, 3, 1, "assistant", "c", 0.9),
        (1, 4, 2, "us:er", "d", 1.0), (1, 5, 4, "assistant", None, 0.5), (1, 9, 8, "user", "cycle", 1.0), (1, 8, 9, "user", "cycle", 1.0),
        (2, 1, 77, "user", "orphan", None)], "conv long, node long, parent long, role string, text string, score double")
    got = reply_trees.format_paths(nodes, 2)
    got = got.select("conv", "path", reply_trees.parse(F.col("formatted")).alias("turns"),
                     reply_trees.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    rows = {(r.conv, r.path): ([tuple(t) for t in r.turns], r.loss) for r in got.collect()}
    assert rows == {
        (1, 1): ([("user", "hi ## :x \\"), ("assistant", "a</turn>\n### user: b###"), ("us:er", "d"), ("assistant", "")], "a</turn>\n### user: b###"),
        (1, 2): ([("user", "hi ## :x \\"), ("assistant", "c")], "c"), (2, 1): ([("user", "orphan")], "")}
    assert reply_trees.format_paths(nodes.limit(0)).count() == 0


def test_reply_trees_against_walks(spark):
    """Random forests of one to 40 nodes, with equal scores and a chain, against a plain walk."""
    r, rows = random.Random(5), []
    for c in range(12):
        for i in range(1 if c == 0 else 3 * c):
            parent = None if i == 0 else i - 1 if c == 11 else r.choice([None, *range(i)])
            rows.append((c, i, parent, "user", f"{c}.{i}", r.choice([0.0, 0.5])))
    want = {}
    for c in range(12):
        mine = {n: (p, s) for cc, n, p, _, _, s in rows if cc == c}
        walks = []
        for n in mine.keys() - {p for p, _ in mine.values()}:
            walk = [n]
            while mine[walk[-1]][0] is not None:
                walk.append(mine[walk[-1]][0])
            walks.append((-sum(mine[x][1] for x in walk), -len(walk), n, walk[::-1]))
        for k, (_, _, _, walk) in enumerate(sorted(walks)[:2]):
            want[c, k + 1] = [f"{c}.{x}" for x in walk]
    nodes = spark.createDataFrame(rows, "conv long, node long, parent long, role string, text string, score double")
    got = reply_trees.format_paths(nodes, 2).select("conv", "path", reply_trees.parse(F.col("formatted")).alias("t")).collect()
    assert {(x.conv, x.path): [t.text for t in x.t] for x in got} == want


def test_conversations(spark):
    got = {r.conv_id: r for r in queries.QUERIES["op9_reply_trees"](spark, SF).collect()}
    text = "\\### Assistant: </turn> ok"
    assert got[-7].loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and got[-7].loss_chars == len(text)
    assert got[-7].turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_url_templates(spark):
    urls = [("https://WWW.Example.com/en/1?x", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
            ("http://a.example.com/en/2#t", "a.example.com", "/en/2", "example.com/en/", "block"), ("x://b.com", "b.com", "", None, "allow"),
            ("http://n.net/fr/", "n.net", "/fr/", "net/fr/", "block"), (None, "", "", None, "allow"), ("none", "", "", None, "allow")]
    rows = [(i, u, None) for i, (u, *_) in enumerate(urls)] + [(100 + i, f"http://h.org/bad/{i}", 0) for i in range(40)] \
        + [(200 + i, f"http://h.org/good/{i}", 1) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, good int")
    got = {r.page_id: r for r in url_templates.judge(pages, good=F.col("good") == 1).collect()}
    assert len(got) == len(rows)
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict)
    assert got[100].verdict == "block" and got[200].verdict == "allow" and got[100].template == "/bad/{n}"


def test_url_similar_branches(spark):
    """Some similar branches without a good page are judged together, one that differs by itself."""
    rows = [(i, f"http://ok.org/a/{i}", 1) for i in range(300)]
    rows += [(1000 + i, f"http://few.org/{'abcdefghijklmno'[i % 15]}/{i}", 0) for i in range(60)]
    rows += [(2000 + i, f"http://two.org/{'xy'[i % 2]}/{i}", 0) for i in range(18)] + [(3000 + i, f"http://few.org/good/{i}", 1) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, good int")
    got = {r.page_id: (r.template, r.verdict) for r in url_templates.judge(pages, good=F.col("good") == 1).collect()}
    assert {got[i] for i in range(1000, 1060)} == {("/*/{n}", "block")}
    assert {got[i] for i in range(2000, 2018)} == {("/*/{n}", "block")} and {got[i] for i in range(3000, 3040)} == {("/good/{n}", "allow")}


def test_url_deep_paths(spark):
    deep = "http://h.org/a/b/c/d/e/f/g/"
    rows = [(i, f"{deep}good/x/{i}", 1) for i in range(60)] + [(100 + i, f"{deep}spam/x/{i}", 0) for i in range(60)]
    rows += [(200, "http://h.org/" + "z/" * 300 + "1", None), (201, "http://one.org/" + "z/" * 300 + "1", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, good int")
    got = {r.page_id: (r.template, r.verdict) for r in url_templates.judge(pages, good=F.col("good") == 1).collect()}
    assert len(got) == len(rows) and got[201][0].count("/z") == 300
    assert got[5] == (got[5][0], "allow") and got[105][1] == "block" and got[5][0].endswith("/good/x/{n}") and got[105][0].endswith("/spam/x/{n}")


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", language.held_out(F.col("doc_id")))
    model = language.learn(docs.where("not held_out"), per_language=100)
    got = language.predict(docs, model)
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !!")], "doc_id long, text string")
    assert {(r.lang_pred, r.score) for r in language.predict(odd, model).collect()} == {("und", 0.0)}
    assert language.predict(odd, language.learn(docs.limit(0))).count() == 3


def test_language_of_copies(spark):
    """A language whose rows are copies is learned; copies do not go beyond the bound."""
    rows = [(i, "uno due tre", "aa") for i in range(200)] + [(1000 + i, f"one two {'xyz'[i % 3] * (i + 1)}", "bb") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = language.drawn(docs.select(F.col("text").alias("t"), "lang"), 20).groupBy("lang").count().collect()
    assert {(r["lang"], r["count"]) for r in got} == {("aa", 1), ("bb", 20)}
    model = language.learn(docs, per_language=1)
    assert sorted(x for f in model["families"] for x in f) == ["aa", "bb"]
    assert {r.lang_pred for r in language.predict(docs.where("lang = 'aa'"), model).collect()} == {"aa"}


def test_pipeline(spark):
    import corpus_pipeline
    docs = queries.table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count() > 0


def test_jaccard_of_long_texts(spark):
    """Sets with long parities: links at and around the threshold are those of brute force, and
    the classes of different parity never exceed the members that differ."""
    r = random.Random(11)
    rows, pool = [], [f"w{i}" for i in range(400)]
    for g, size in enumerate((500, 900, 1500, 2600)):
        base = [r.choice(pool) for _ in range(size)]
        for k, share in enumerate((0.0, 0.02, 0.14, 0.15, 0.24, 0.26, 0.3)):
            cut = int(size * share)
            rows.append((100 * g + 2 * k, base[:size - cut]))
            rows.append((100 * g + 2 * k + 1, base[cut // 2:] + [f"x{g}-{k}-{i}" for i in range(cut // 2)]))
    docs = spark.createDataFrame([(i, " ".join(t), "s", None) for i, t in rows], SCHEMA)
    sets = {i: {tuple(t[j:j + 5]) for j in range(len(t) - 4)} for i, t in rows}
    links = [(a, b) for a in sets for b in sets if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = {i: i for i in sets}
    for _ in rows:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {x.doc_id: x.component_id for x in jaccard_join.join_documents(docs).collect()}
    assert got == root and len(set(root.values())) > 4
    hashes = {i: np.unique(jaccard_join.shingle_rows(*flat(" ".join(t)))[0]) for i, t in rows}
    for a in hashes:
        for b in hashes:
            x, y = jaccard_join.wide_parities(hashes[a]), jaccard_join.wide_parities(hashes[b])
            if x and y:
                apart = len(np.setxor1d(hashes[a], hashes[b]))
                assert jaccard_join.wide_differ(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) <= apart


def flat(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return raw, np.array([0, len(raw)])


def test_jaccard_entries_without_partner_are_dropped():
    """Kept is every entry that a pair filter passes with another of its group, and of groups of two no other."""
    from riskframe.llm.jaccard_join import has_partner
    rng = np.random.default_rng(5)
    many = rng.integers(1, 5, 400)
    lead = np.append(0, np.cumsum(many)[:-1])
    n = rng.integers(1, 60, many.sum()).astype(np.uint32)
    pos = (rng.random(len(n)) * (n - -(-n.astype(np.int64) * 75 // 100) + 1)).astype(np.uint32)
    kept = has_partner(lead, many, n, pos, 75)
    dropped = 0
    for at, m in zip(lead, many):
        for i in range(at, at + m):
            def links(j):
                a, b, p, q = int(n[i]), int(n[j]), int(pos[i]), int(pos[j])
                return 100 * min(a, b) >= 75 * max(a, b) and 175 * (min(p, q) + 1 + min(a - p, b - q) - 1) >= 75 * (a + b)
            want = any(links(j) for j in range(at, at + m) if j != i)
            assert kept[i] or not want
            assert m > 2 or kept[i] == want
            dropped += not kept[i]
    assert dropped > len(n) // 4


def test_jaccard_groups_of_the_same_nodes_are_one(spark):
    """Two near copies meet once, not once for every shingle they share in their prefixes; a
    third set that shares some of these shingles makes few groups more."""
    r = random.Random(23)
    base = [f"w{r.randrange(10 ** 6)}" for _ in range(400)]
    texts = [base[:320] + [f"z{i}" for i in range(20)], base[:320] + [f"x{i}" for i in range(100)], base[:40] + [f"y{i}" for i in range(360)]]
    docs = spark.createDataFrame([(i, " ".join(t), "s", None) for i, t in enumerate(texts)], SCHEMA).select("doc_id", "text")
    cells = np.zeros(1 << 16, np.uint8)
    two = jaccard_join.prefix_groups(docs.where("doc_id < 2"), "text", cells, 7, 5, 75).collect()
    assert len({x.node for x in two}) == 2 == len(two) and len({x.h for x in two}) == 1
    assert len({x.many for x in two}) == 1 and two[0].many > 10
    three = jaccard_join.prefix_groups(docs, "text", cells, 7, 5, 75).collect()
    assert 2 < len(three) <= 3 * 2 + 3


def test_same_members_against_brute_force():
    rng = np.random.default_rng(3)
    sets, place = [], {}
    for g in range(300):
        nodes = sorted(rng.choice(6, rng.integers(2, 5), replace=False).tolist())
        sets.append(nodes)
        place |= {(g, x): g // 3 + 10 * x + 1 for x in nodes}                   # ascending with g in all nodes
    h = np.array([g for g, s in enumerate(sets) for _ in s], np.uint64)
    node = np.array([x for s in sets for x in s], np.uint64)
    pos = np.array([place[g, x] for g, s in enumerate(sets) for x in s], np.uint32)
    at, name, many = jaccard_join.same_members(h, node + np.uint64(7), node, pos)
    want = Counter(tuple(s) for s in sets)
    got = {}
    for i, k, m in zip(at.tolist(), name.tolist(), many.tolist()):
        got.setdefault(k, []).append((int(node[i]), int(pos[i]), m))
    assert {tuple(x for x, _, _ in v): v[0][2] for v in got.values()} == {s: c * len(s) for s, c in want.items()}
    for v in got.values():
        first = next(g for g, s in enumerate(sets) if s == [x for x, _, _ in v])
        assert [p for _, p, _ in v] == [place[first, x] for x, _, _ in v]


def test_sketch_counts_every_shingle(spark):
    """Cells in use are told by places where they are few and by bits where they are many."""
    r = random.Random(31)
    texts = [" ".join(f"w{r.randrange(10 ** 6)}" for _ in range(20_000)), "a b c d e f g " * 300, "a b", None, ""]
    docs = spark.createDataFrame([(i, t, "s", None) for i, t in enumerate(texts)], SCHEMA)
    for some in (docs, docs.where("doc_id > 0")):
        got = jaccard_join.sketch(some.repartition(3), "text", size=1)
        want = np.zeros(1 << 16, np.int64)
        for x in some.collect():
            if x.text:
                np.add.at(want, (jaccard_join.shingle_rows(*flat(x.text))[0] & np.uint64((1 << 16) - 1)).astype(np.int64), 1)
        assert (got == np.minimum(8 * np.log2(1 + want), 255).astype(np.uint8)).all() and got.any()
