"""Small fixtures against brute force, round trips, and the edge cases every operator has to take."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import bitmap, budget, consensus, cutoff, encode, langid, lines, overlap, pack, pii, quota, tokenizer, wordtable

DOC = "document_id string, text string, metadata struct<url:string,language:string,dump:string,token_count:int>, scores struct<score:double>, lang string, site string, label bigint, k string"


def doc(i, text, url="https://a.example/x", lang="en", score=1.0, tokens=5, dump="2020"):
    return (i, text, (url, lang, dump, tokens), (score,), "clash", "clash", 7, "clash")


@pytest.fixture()
def empty_docs(spark):
    return spark.createDataFrame([], DOC)


# ------------------------------------------------------------------------------------------------------------ consensus

ANN = "document_id string, scores array<double>, meta_information struct<model:string>, label int"


def simulated(n, seed=3, flip=None):
    r = random.Random(seed)
    acc = {"a/x": 0.85, "b/x": 0.8, "c/x": 0.7, "d/x": 0.65, "e/x": 0.2}
    truth, rows = {}, []
    for i in range(n):
        t = truth[f"d{i}"] = r.choices(range(6), [4, 5, 4, 3, 2, 1])[0]
        for m, p in acc.items():
            v = t if r.random() < p else r.randrange(6)
            rows.append((f"d{i}", [float(5 - v if m == flip else v)], (m.replace("/", r.choice(["/", "__", "--"])),), 1))
    return truth, rows


def test_consensus_beats_the_best_annotator_and_reads_inverted_ones(spark):
    truth, rows = simulated(1500, flip="d/x")
    lab, ann = consensus.consensus(spark.createDataFrame(rows, ANN))
    got = {r.document_id: r.label for r in lab.collect()}
    right = np.mean([got[d] == t for d, t in truth.items()])
    assert right > 0.9
    by = {r.annotator: r for r in ann.collect()}
    assert by["d/x"].inverted and not by["a/x"].inverted
    assert by["a/x"].accuracy > by["c/x"].accuracy > by["e/x"].accuracy


def test_many_annotators_go_the_same_way(spark):
    r = random.Random(13)
    acc = {f"m{i:02d}": r.choice([0.9, 0.8, 0.6, 0.3]) for i in range(70)}
    truth, rows = {}, []
    for i in range(1500):
        t = truth[f"d{i}"] = r.choices(range(6), [4, 5, 4, 3, 2, 1])[0]
        rows += [(f"d{i}", [float(t if r.random() < acc[m] else r.randrange(6))], (m,), 1) for m in r.sample(sorted(acc), 8)]
    lab, ann = consensus.consensus(spark.createDataFrame(rows, ANN))
    assert np.mean([truth[x.document_id] == x.label for x in lab.collect()]) > 0.93  # 0.985 with the true tables
    got = {x.annotator: x.accuracy for x in ann.collect()}
    assert len(got) == 70 and np.corrcoef([got[m] for m in acc], list(acc.values()))[0, 1] > 0.9


def test_tables_of_shifted_and_copying_annotators(spark):
    r = random.Random(14)
    truth, rows = {}, []
    for i in range(4000):
        t = truth[f"d{i}"] = r.choices(range(6), [4, 5, 4, 3, 2, 1])[0]
        near = lambda p: t if r.random() < p else min(5, max(0, t + r.choice([-1, 1])))  # noqa: E731, B023
        copied = float(near(0.6))
        votes = {"a": near(0.85), "b": min(5, near(0.85) + 1), "c": near(0.8), "d": near(0.75), "e": copied, "f": copied}
        rows += [(f"d{i}", [float(v)], (m,), 1) for m, v in votes.items()]
    lab, ann = consensus.consensus(spark.createDataFrame(rows, ANN))
    by = {x.annotator: x for x in ann.collect()}
    assert list(by["e"].dependent_on) == ["f"] and list(by["a"].dependent_on) == []
    assert abs(by["a"].accuracy - 0.85) < 0.05 and by["b"].accuracy < 0.5 and by["b"].reliability > 0.5
    assert np.mean([truth[x.document_id] == x.label for x in lab.collect()]) > 0.93


def test_consensus_edges(spark):
    rows = [("d", [3.0], ("m",), 1)] * 2 + [("d", [float("nan"), None, 9.0], ("n",), 1), ("e", None, ("m",), 1), (None, [1.0], ("m",), 1), ("f", [], ("m",), 1), ("g", [2.0], (None,), 1)]
    lab, _ = consensus.consensus(spark.createDataFrame(rows, ANN))
    r = lab.collect()
    assert [x.document_id for x in r] == ["d"] and r[0].label == 3 and r[0].agreement is None and r[0].n_annotators == 1
    lab, ann = consensus.consensus(spark.createDataFrame([], ANN))
    assert lab.count() == 0 and ann.count() == 0


# ---------------------------------------------------------------------------------------------------------------- quota

TARGET = "plan_name string, cell_no bigint, lang_code string, score_min double, score_max double, target_pct bigint, min_docs bigint, sample_pct bigint"


def greedy_seats(counts, weights, minimum, size):
    got = [min(m, c) for m, c in zip(minimum, counts)]
    while sum(got) < size:
        best = min(((g + 0.5) / w, i) for i, (g, w, c) in enumerate(zip(got, weights, counts)) if w > 0 and g < c)
        got[best[1]] += 1
    return got


def test_seats_equal_one_by_one_assignment():
    r = random.Random(1)
    for _ in range(200):
        k = r.randint(1, 6)
        counts, weights = [r.randint(0, 30) for _ in range(k)], [r.randint(1, 20) for _ in range(k)]
        minimum = [r.randint(0, 4) for _ in range(k)]
        size = r.randint(sum(min(m, c) for m, c in zip(minimum, counts)), max(sum(counts), 0))
        assert quota.seats(counts, weights, minimum, size) == greedy_seats(counts, weights, minimum, size)


def test_quota_sample_and_report(spark, empty_docs):
    docs = spark.createDataFrame([doc(f"e{i}", "x", lang="EN-us", score=float(i % 6)) for i in range(60)] + [doc(f"d{i}", "x", lang=" de ", score=2.0) for i in range(5)] + [doc("x", "x", lang=None), doc("y", "x", score=float("nan"))] + [doc("d0", "x", lang=" de ", score=2.0)], DOC)
    plan = spark.createDataFrame([("p", 0, "en", None, None, 50, 1, 40), ("p", 1, "de", None, None, 50, 1, 40), ("p", 2, "mt", None, None, 0, 1, 40)], TARGET)
    s = quota.sample(docs, plan).collect()
    n = {c: sum(1 for r in s if r.cell_no == c) for c in (0, 1, 2)}
    assert n == {0: 21, 1: 5, 2: 0} and len({r.document_id for r in s}) == 26
    assert {(r.plan_name, r.cell_no) for r in quota.unmet(docs, plan).collect()} == {("p", 1), ("p", 2)}
    rep = {r.cell_no: r for r in quota.report(docs, plan).collect()}
    assert rep[0].available == 60 and rep[0].target_met and not rep[2].minimum_met
    assert quota.sample(empty_docs, plan).count() == 0
    assert quota.unmet(empty_docs, plan).count() == 3  # every minimum is missed
    assert quota.unmet(docs, spark.createDataFrame([], TARGET)).count() == 0


# --------------------------------------------------------------------------------------------------------------- cutoff


def test_cutoffs_against_sorting(spark, empty_docs):
    r = random.Random(2)
    rows = [doc(f"{l}{i}", "x", lang=l, score=r.choice([0.5, 1.0, 1.5, 2.25, 3.0, r.random() * 5])) for l in ("en", "de") for i in range(150)]
    docs = spark.createDataFrame(rows + rows[:3] + [doc("n", "x", lang="en", score=None), doc("i", "x", lang="en", score=float("inf"))], DOC)
    t = spark.createDataFrame([("en", 30), ("de", 100), ("xx", 10)], "lang_code string, keep_pct bigint")
    got = {x.lang_code: x for x in cutoff.cutoffs(docs, t).collect()}
    for lang, pct in (("en", 30), ("de", 100)):
        s = sorted((x[3][0] for x in rows if x[0].startswith(lang)), reverse=True)
        want = max(c for c in s if sum(v >= c for v in s) * 100 >= pct * len(s))
        assert got[lang].cutoff == want and got[lang].n_kept == sum(v >= want for v in s)
        assert cutoff.kept(docs, t).filter(F.col("lang_code") == lang).count() == got[lang].n_kept
        close = cutoff.cutoffs(docs, t, "closest").filter(F.col("lang_code") == lang).first()
        best = min(abs(sum(v >= c for v in s) - pct * len(s) / 100) for c in s)
        assert math.isclose(abs(close.n_kept - pct * len(s) / 100), best)
    assert "xx" not in got and cutoff.kept(empty_docs, t).count() == 0


# --------------------------------------------------------------------------------------------------------------- langid

EN = "the house and the river are near the old town because it was a long day "
DE = "das haus und der fluss sind nahe der alten stadt weil es ein langer tag war "


def test_language_of_documents_and_lines(spark, empty_docs):
    rows = [doc(f"e{i}", EN * 3, lang="en") for i in range(8)] + [doc(f"d{i}", DE * 3, lang="de") for i in range(8)]
    rows += [doc("wrong", EN * 3, lang="de"), doc("none", DE * 3, lang=None), doc("mix", "\n".join([EN * 2, DE, EN, "", EN]), lang="en"), doc("quote", EN * 3 + " said das haus", lang="en")]
    rows += [doc("null", None, lang="en"), doc("empty", "", lang="en"), doc("blank", " \n ", lang=None), doc("digits", "12 34 " * 30, lang="en"), doc("long", EN * 4000, lang="en")]
    rows += rows[:2]
    docs = spark.createDataFrame(rows, DOC)
    got = {(r.document_id, r.line_no, r.lang_code) for r in langid.found(docs).collect()}
    assert got == {("wrong", 0, "en"), ("none", 0, "de"), ("mix", 2, "de")}
    assert langid.found(empty_docs).count() == 0


def test_words_unknown_to_the_model_fall_back_to_their_characters():
    m = langid.fit([("en", EN)] * 8 + [("de", DE)] * 8 + [("und", EN), ("und", DE)] * 3)
    assert m.languages == ("de", "en")  # und names no language
    assert m.score("the")[1] > m.score("the")[0]
    assert m.score("derr")[0] > m.score("derr")[1]


# -------------------------------------------------------------------------------------------------------------- overlap


def lev(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def test_banded_distance_is_exact_up_to_its_limit():
    r = random.Random(4)
    a = [np.array([r.randint(0, 4) for _ in range(r.randint(0, 14))]) for _ in range(300)]
    b = [np.array([x for x in w if r.random() > 0.2] + [r.randint(0, 4) for _ in range(r.randint(0, 4))]) for w in a]
    lim = np.array([r.randint(0, 8) for _ in a])
    for x, y, k, d in zip(a, b, lim, overlap.banded_distance(a, b, lim)):
        assert min(d, k + 1) == min(lev(x, y), k + 1)


def test_overlaps_between_splits(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(60)]
    edited = [w if i % 11 else word() for i, w in enumerate(base)]
    moved = base[6:30] + base[:6] + base[30:]
    passage = base[:36] + [word() for _ in range(24)]
    rows = [
        ("1", " ".join(base), "train"), ("2", " ".join(base).upper() + " !", "val"), ("3", " ".join(edited), "test"), ("4", " ".join(moved), "val"), ("5", " ".join(passage), "val"),
        ("6", " ".join(base), "train"), ("7", None, "val"), ("8", "", "train"), ("9", "", "val"), ("10", "a b c", "train"), ("11", "A, b c", "test"), ("12", "?!", "train"), ("13", " ?!", "val"), ("14", " ".join(base), "other"),
    ]
    df = spark.createDataFrame(rows + rows[:2], "id string, text string, split string").withColumn("source", F.lit("s")).withColumn("n", F.lit(1))
    got = {tuple(x) for x in overlap.found(df).collect()}
    want = {tuple(sorted((a, b))) for a in ("1", "6") for b in ("2", "3", "4")} | {("10", "11"), ("12", "13")}
    assert got == want
    assert sum(x.n_pairs for x in overlap.report(df).collect()) == len(want)
    assert overlap.found(df.filter("false")).count() == 0


def test_edits_within_the_bound_are_always_found_and_agree_with_all_pairs(spark):
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    forms = [[word() for _ in range(8)] for _ in range(6)]  # sentence forms that all texts share
    rows = []
    for i in range(120):
        n = r.choice([7, 8, 14, 20, 27, 33, 34, 47, 64, 65, 90])
        base = [w for f in r.choices(forms, k=n // 16) for w in f]
        base += [word() for _ in range(n - len(base))]
        new = list(base)
        for at in r.sample(range(n), int(overlap.MAX_EDITS * n)):
            kind = r.random()
            new[at] = word() if kind < 0.6 else "" if kind < 0.8 else new[at] + " " + word()
        rows += [(f"t{i}", " ".join(base), "train"), (f"e{i}", " ".join(w for w in new if w), "val")]
    got = {tuple(x) for x in overlap.found(spark.createDataFrame(rows, "id string, text string, split string")).collect()}
    seq = {i: overlap._word_ids(overlap.word_list(t)) for i, t, _ in rows}
    pairs = [(a, b) for a in seq for b in seq if a[0] == "t" and b[0] == "e"]
    ok = overlap.light_edits([seq[a] for a, _ in pairs], [seq[b] for _, b in pairs])
    assert got == {tuple(sorted(p)) for p, d in zip(pairs, ok) if d >= 0} and len(got) >= 110


def test_bitmap_lets_through_all_wanted_keys_and_little_else(spark):
    keys = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 20_000)
    f = bitmap.key_filter(spark.createDataFrame([(int(k),) for k in keys[:5000]], "key bigint").repartition(3), bitmap.of_column("key"), 5000)
    assert bitmap.passes(f, keys[:5000]).all() and bitmap.passes(f, keys[5000:]).mean() < 0.05


# ------------------------------------------------------------------------------------------------- tokens, encode, pack

TEXTS = [None, "", " ", "Hello world, it's 2024!\n\n  Grüße   ﬁn 😀 日本語", "a" * 5000, "x y " * 3000, "'s 'RE <|endoftext|>", "a\x1cb c​d"]


def test_encoding_equals_the_tokenizer_and_decodes(spark):
    df = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, ids array<int>")
    enc = tokenizer.byte_bpe()
    got = encode.encode(df)
    assert {r.doc_id: list(r.ids) for r in got.collect()} == {i: enc.encode_ordinary(t or "") for i, t in enumerate(TEXTS)}
    assert {r.doc_id: r.text for r in encode.decode(got).collect()} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert encode.encode(df.filter("false")).count() == 0


def test_untrusted_counts_and_budget(spark, empty_docs):
    long = "some words stand here " * 8
    n = len(tokenizer.byte_bpe().encode_ordinary(long))
    rows = [doc("ok", long, tokens=n), doc("null", long, tokens=None), doc("zero", long, tokens=0), doc("twice", long, tokens=2 * n), doc("more", long, tokens=2 * n + 1), doc("less", long, tokens=n // 2 - 1), doc("short", "a b", tokens=None), doc("none", None, tokens=None)]
    docs = spark.createDataFrame(rows + rows[:1], DOC)
    assert {r.document_id for r in budget.untrusted(docs).collect()} == {"null", "zero", "more", "less"}
    b = budget.budget(docs).collect()
    assert len(b) == 1 and b[0].n_docs == 8 and b[0].site == "a.example" and b[0].n_tokens == 6 * n + len(tokenizer.byte_bpe().encode_ordinary("a b"))
    assert budget.untrusted(empty_docs).count() == 0 and budget.budget(empty_docs).count() == 0


def test_unigram_path_is_the_best_of_all_segmentations():
    r = random.Random(6)
    pieces = {p: -r.random() * 5 for p in ["a", "b", "c", "ab", "bc", "abc", "ca", "cab", "é"]}
    trie = budget.DoubleArrayTrie([p.encode() for p in pieces], list(pieces.values()))
    unknown = min(pieces.values()) - 10

    def brute(w):
        if not w:
            return [(0.0, 0)]
        out = [(s + (pieces.get(w[:k]) if w[:k] in pieces else unknown), n + 1) for k in range(1, min(3, len(w)) + 1) if w[:k] in pieces or k == 1 for s, n in brute(w[k:])]
        return out

    for _ in range(200):
        w = "".join(r.choice("abcéx") for _ in range(r.randint(0, 7)))
        assert trie.count(w) == max(brute(w))[1]


def test_paths_over_the_trie_are_the_tokenizers(spark):
    r = random.Random(15)
    for name in ("byte_bpe_50k", "byte_bpe_multi_50k"):
        enc, paths = tokenizer.byte_bpe(name), budget.MergePaths(tokenizer.ranks(name))
        words = [" straße", "'s", "\n\n", "日本語", "😀😀", "a" * 3000, " internationalisation", "x" * 7 + "é", "1234567"]
        words += ["".join(r.choice("abcdefghijklmnopqrstuvwxyzäöüßéñčш ЩΩ日本") for _ in range(r.randint(1, 25))) for _ in range(3000)]
        words += ["".join(r.choices([p.decode("latin-1") for p in list(tokenizer.ranks(name))[:4000:7]], k=3)) for _ in range(2000)]
        for w in words:
            assert paths.count(w) == len(enc._encode_single_piece(w)), w
    with pytest.raises(ValueError, match="no unigram vocabulary"):
        budget._unigram_counts("piece_bpe_32k", tokenizer.DEFAULT_DIR)(["a"])


def test_results_of_frequent_and_rare_words_meet_in_every_block(spark):
    r = random.Random(16)
    rows = [(i, " ".join(r.choices(["the", "of", "and", f"rare{i}", f"odd{i % 7}"], k=30))) for i in range(200)] + [(200, None), (201, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    b = wordtable.blocks(df, ["doc_id"])
    hot = wordtable.hot_words(b)
    assert {" the", " of", " and"} <= set(hot) and b.count() >= 5
    enc = tokenizer.byte_bpe()
    assert {x.doc_id: list(x.ids) for x in encode.encode(df).collect()} == {i: enc.encode_ordinary(t or "") for i, t in rows}


def test_packing_is_whole_and_within_capacity(spark):
    r = random.Random(7)
    rows = [(i, "word%d " % (i % 7) * r.randint(0, 200), f"s{i % 5}") for i in range(300)] + [(300, None, None), (301, "", "s1"), (302, "long " * 5000, "s1")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("n_tokens", F.lit(1)).withColumn("shard", F.lit("x"))
    caps = spark.createDataFrame([(1, 256), (2, 4096), (3, None)], "capacity_id bigint, capacity_tokens bigint")
    got = pack.pack(df, caps).collect()
    enc = tokenizer.byte_bpe()
    size = {i: len(enc.encode_ordinary(t or "")) for i, t, _ in rows}
    for cid, cap in ((1, 256), (2, 4096)):
        mine = [x for x in got if x.capacity_id == cid]
        box, have = {}, {}
        for x in mine:
            have.setdefault(x.doc_id, []).append((x.token_start, x.n_tokens))
            if x.container_id is not None:
                box[x.container_id] = box.get(x.container_id, 0) + x.n_tokens
        assert set(have) == set(size) and max(box.values()) <= cap
        for i, parts in have.items():
            at = 0
            for start, n in sorted(parts):
                assert start == at
                at += n
            assert at == size[i] and len(parts) == max(1, -(-size[i] // cap))
    fill = {x.capacity_id: x.fill for x in pack.fill_report(pack.pack(df, caps), caps).collect()}
    assert fill[1] > 0.9
    assert pack.pack(df.filter("false"), caps).count() == 0


def test_index_holds_every_shared_term_and_neighbours_are_those_of_the_full_index(spark):
    r = random.Random(11)
    vocab = ["".join(r.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(300)]
    rows = [(i, " " + " ".join(r.choices(vocab, k=r.randint(60, 200))), "s") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    tf = [Counter(t.split()) for _, t, _ in rows]
    df = Counter(w for c in tf for w in c)
    mean = sum(len(t) / 6 for _, t, _ in rows) / len(rows)
    idf = {w: math.log(1 + (80 - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    bm = [{w: idf[w] * n * (pack.K1 + 1) / (n + pack.K1 * (1 - pack.B + pack.B * c.total() / mean)) for w, n in c.items() if df[w] > 1} for c in tf]
    items = sorted(pack._terms(docs, "doc_id", "text", "source", "byte_bpe_50k", tokenizer.DEFAULT_DIR).collect(), key=lambda x: x.doc_id)
    assert [len(x.terms) for x in items] == [len(b) for b in bm] and min(map(len, bm)) > 24
    index = pack.Index([np.array(x.terms) for x in items], [np.array(x.weights, np.float32) for x in items])
    for i in range(80):
        full = np.array([sum(b.get(w, 0.0) for w in bm[i]) for b in bm])
        assert np.allclose(index.scores(i), full, rtol=1e-4)
        assert len(set(np.argsort(-index.scores(i))[:20]) & set(np.argsort(-full)[:20])) >= 19


# ---------------------------------------------------------------------------------------------------------------- lines


def test_repeated_lines(spark, empty_docs):
    u = lambda i: chr(97 + i // 26) + chr(97 + i % 26)
    rows = [doc(f"a{i}", f"Own text {u(i)}\n  Share   THIS page {i}\n\n12 34", url="http://WWW.A.example:80/p") for i in range(6)]
    rows += [doc(f"b{i}", "Share this page 1" if i < 5 else f"other words stand {u(i)} right here", url="https://b.example/") for i in range(60)]
    rows += [doc("n", "Share this page 1", url=None), doc("z", None, url="https://a.example"), rows[0]]
    docs = spark.createDataFrame(rows, DOC)
    got = {(r.document_id, r.line_no) for r in lines.repeated_lines(docs).collect()}
    assert got == {(f"a{i}", 2) for i in range(6)}  # 5 of 60 documents of b are less than a tenth
    clean = {r.document_id: r for r in lines.without_repeated(docs).collect()}
    assert clean["a3"].text == "Own text ad\n\n12 34" and clean["a3"].n_removed == 1
    assert clean["n"].text == "Share this page 1" and clean["z"].text is None and len(clean) == 68
    t = {(r.site, r.template): r.n_docs for r in lines.templates(docs).collect()}
    assert t == {("a.example", "share this page 0"): 6, ("b.example", "other words stand <*> right here"): 55}
    clean = {r.document_id: r for r in lines.without_repeated(docs, whole_templates=True).collect()}
    assert clean["b7"].text == "" and clean["b2"].text == "Share this page 1" and clean["a3"].text == "Own text ad\n\n12 34"
    assert lines.repeated_lines(empty_docs).count() == 0


# ------------------------------------------------------------------------------------------------------------------ pii

PERSONS = [("Alice", "Corthrum"), ("Brian", "Marthrum"), ("Clara", "Wickthrum"), ("Edith", "Dunthrum"), ("Walter", "Ashthrum")]


def pii_rows(n, seed=8):
    r, rows, truth = random.Random(seed), [], set()
    for i in range(n):
        g, f = r.choice(PERSONS)
        mail = f"{g.lower()}.{f.lower()}@mail-{r.choice('abc')}.example.com"
        phone = f"{r.randint(200, 999)}-555-0{r.randint(100, 199)}"
        ssn = f"{r.randint(900, 999)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}"
        street = f"{r.randint(1, 199)} Oakmere {r.choice(['Street', 'Lane', 'Road'])}"
        t = f"The page was written by {g} {f}. Please write to {mail} today. Call {phone} to book.\nPassport number {ssn} was on it. Address: {street}, Talmere.\nOrder no. {r.randint(1000, 9999)}-{r.randint(100000, 999999)}\nVersion 3.{r.randint(10, 99)}.{r.randint(100, 999)}"
        rows.append((i, t))
        truth |= {(i, "name", f"{g} {f}"), (i, "email", mail), (i, "phone", phone), (i, "id_number", ssn), (i, "address", street)}
    return rows, truth


def test_personal_data_on_held_out_texts(spark):
    rows, truth = pii_rows(120)
    docs = spark.createDataFrame(rows + [(900, None), (901, ""), (902, "nothing " * 30000)] + rows[:1], "doc_id bigint, text string").withColumn("pii_kind", F.lit("x"))
    names = spark.createDataFrame([(g, "en") for g, _ in PERSONS] + [(None, "en")], "given_name string, lang_code string")
    got = {tuple(x) for x in pii.found(docs, names).collect()}
    assert len(got & truth) / len(truth) > 0.97 and len(got & truth) / len(got) > 0.97
    red = {r.doc_id: r.text for r in pii.redact(docs, names).collect()}
    assert "[EMAIL]" in red[1] and "[NAME]" in red[1] and red[900] is None and red[901] == ""
    assert pii.found(docs.filter("false"), names).count() == 0
    assert pii.found(docs, names.filter("false")).filter("pii_kind = 'email'").count() == 120


def test_names_whose_given_name_and_ending_are_unknown_or_rare(spark):
    rows, _ = pii_rows(120)
    far = [(500, "It was Alice Queslamp who came.\nAlice Norlamp too."), (501, "The page was written by Zorvek Tarlamp. Nothing else."), (502, "The page was written by Zorvek Quidde. Nothing else.")]
    docs = spark.createDataFrame(rows + far, "doc_id bigint, text string")
    names = spark.createDataFrame([(g, "en") for g, _ in PERSONS], "given_name string, lang_code string")
    given = pii.given_names(names)
    endings = pii.surname_endings(docs, given)
    model = pii.fit([t for _, t in rows], given, endings)  # the documents that hold the rare ending are not in the sample
    assert model.surname("Tarlamp") >= 0.3 and model.surname("Street") == 0
    got = {tuple(x) for x in pii.found(docs.filter("doc_id > 500"), names, model=model).collect()}
    assert got == {(501, "name", "Zorvek Tarlamp"), (502, "name", "Zorvek Quidde")}


def test_surname_endings_of_a_large_corpus(spark):
    """What grows with a corpus, handles that end in family names and chance meetings, leaves the shares of the endings as they are."""
    given = {g for g, _ in PERSONS}
    rows, handles = [], [f"{g}{i}_{f}" for g, f in PERSONS for i in range(40)] + [f"{g}{c}{f}@mail.example" for g, f in PERSONS for c in "abcdefgh"]
    rows += [f"The page was written by {g} {f}. Write to {h} today." for g, f in PERSONS for h in handles[::5]] + [f"Write to {h} today." for h in handles]
    rows += ["Hello to all. Garden stones."] * 100 + ["Alice Garden, Alice Wharden"]  # Garden meets a given name once in 101
    rows += ["It was Alice B. Norquamp, then Brian Q. Telquamp."]
    got = pii.surname_endings(spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string"), given)
    model = pii.Model(given=frozenset(given), endings=got)
    assert {model.surname(f) for _, f in PERSONS} == {0.7} and model.surname("Ullquamp") == 0.7
    assert model.surname("Garden") == 0.5  # one form of two


def test_only_capitals_begin_a_name():
    small = ["łukasz kowalski", "člen žák", "żeby ęsty", "мария иванова", "ο κινητήρας", "ñandú çok"]
    assert not any(pii.candidates(t, pii.Model()) for t in small)
    for t in ("Łukasz Kowalski", "Čeněk Žák", "Мария Иванова", "Ελένη Κώστα", "Ǆemal Šehić", "Émile Île"):
        assert ("name", t) in {(x.kind, t[x.start : x.end]) for x in pii.candidates(t, pii.Model())}, t


def test_pairs_that_are_not_built_are_in_no_best_segmentation():
    rows, _ = pii_rows(150)
    given = frozenset(g for g, _ in PERSONS[:3])
    forms: dict = {}
    for _, t in rows:
        pii.surname_forms(t, given, forms)
    model = pii.fit([t for _, t in rows], set(given), {"thrum": 0.7})
    whole = pii.Model(model.weights, model.endings, model.given)  # without bounds every pair is built
    for _, t in rows:
        got = {(x.start, x.end, x.kind) for x in pii.find(t, model)}
        assert got == {(x.start, x.end, x.kind) for x in pii.find(t, whole)}


def test_every_group_of_a_run_and_every_written_address_is_a_candidate():
    spans = lambda t: {(x.kind, t[x.start : x.end]) for x in pii.candidates(t, pii.Model())}
    assert ("phone", "0170 1234567") in spans("Am 12.05.2024 0170 1234567 anrufen")
    assert ("phone", "030 1234567") in spans("Call 030 1234567 FOR MORE INFO")
    assert ("phone", "0170 1234567") in spans("1 2 3 4 5 6 7 8 9 10 11 12 0170 1234567")
    for t, a in (("(Via Roma 12)", "Via Roma 12"), ('"Calle Mayor 5"', "Calle Mayor 5"), ("x Calle Mayor, nº12, y", "Calle Mayor, nº12"), ("in Via Roma n.12", "Via Roma n.12"), ("in der Hauptstraße 12-14, Ort", "Hauptstraße 12-14"), ("(Hauptstraße 5)", "Hauptstraße 5")):
        assert ("address", a) in spans(t), t
    assert len(pii.candidates("1234 " * 3000, pii.Model())) < 3000 * 17 * 2


def test_segmentation_is_the_best_of_all():
    r = random.Random(9)
    for _ in range(100):
        spans = [pii.Span(s, s + r.randint(1, 6), "x", [f"f{i}"]) for i, s in enumerate(r.choices(range(12), k=6))]
        w = {f"f{i}": r.uniform(-2, 3) for i in range(6)}
        for g in pii.clusters(spans):
            best = 0.0
            for mask in range(1 << len(g)):
                take = [x for i, x in enumerate(g) if mask >> i & 1]
                if all(a.end <= b.start or b.end <= a.start for i, a in enumerate(take) for b in take[i + 1 :]):
                    best = max(best, sum(w[x.feats[0]] for x in take))
            assert math.isclose(sum(w[x.feats[0]] for x in pii.best(g, w)), best)
