"""Operators for training text against brute force, over rows with every kind of edge."""

import hashlib
import random
import re
import zlib
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

pytest.importorskip("touchline.llm")

from touchline.llm import (  # noqa: E402
    chain_dedup, components, decontaminate, language, minhash_dedup, packing, permutation_index, pii, quality,
    quotations, staging, substring_exact)
from touchline.llm import text as T  # noqa: E402
from touchline.llm.staging import Staging  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, u long, n int, rep long, _text string"


def word(rng):
    return "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))


def prose(rng, n):
    return " ".join(word(rng) + rng.choice(["", "", ",", ".\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    base = prose(rng, 120)
    words = base.split(" ")
    out = [(1, base), (2, base), (3, base.upper())]
    for i in range(4, 24):  # a group of near copies
        w = list(words)
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(len(w))] = word(rng)
        out.append((i, " ".join(w)))
    out += [(i, prose(rng, rng.randint(5, 200))) for i in range(24, 44)]
    shared = prose(rng, 60)
    out += [(i, prose(rng, 50) + " " + shared + " " + prose(rng, 50)) for i in range(44, 50)]
    out += [(50, None), (51, ""), (52, " \n\t "), (53, "one two three"), (54, "one two three"), (55, "x" * 30_000),
            (56, prose(rng, 20_000)), (57, "é ñ ß 漢字 " * 30), (58, "..."), (None, base), (None, None), (59, "a b c d e")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en" if i and i % 2 else None, "s", 1, 0.5, 1, 2, 3, "z") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def shingle_set(text):
    w = word_list(text)
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def least_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}


def test_near_duplicates(docs, rows, none):
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = least_reachable(sets, links)
    got = {r.doc_id: r for r in minhash_dedup.near_duplicates(docs).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(sets[i]), want[i], want[i] == i) for i in sets}
    assert minhash_dedup.near_duplicates(none).count() == 0


def test_keep_one_keeps_rows_without_id(docs, rows):
    kept = minhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert ids.count(None) == 2 and 1 in ids and 2 not in ids and 53 in ids and 54 not in ids


def test_near_duplicates_counts_a_repeated_row_once(docs):
    twice = docs.union(docs)
    assert sorted(map(tuple, minhash_dedup.near_duplicates(twice).collect())) == sorted(
        map(tuple, minhash_dedup.near_duplicates(docs).collect()))


@pytest.mark.parametrize("order", [1, -1])
def test_near_duplicates_of_a_doc_id_with_other_texts(spark, order):
    rng = random.Random(12)
    a, b, c = ([word(rng) for _ in range(n)] for n in (90, 60, 90))
    near = [*a[:-1], "other"]
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join(near)), (3, " ".join(b)), (4, " ".join(a)), (4, " ".join(c)), (5, " ".join(c)), (5, " ".join(c))][::order]
    got = {}
    for parts in (1, 3):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got[parts] = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(df).collect()}
    assert got[1] == got[3] and got[1][1] == (86, 1) and got[1][2] == (86, 1) and got[1][3] == (56, 3)
    # of two equally large sets the one with the greater digest stands for document 4
    big = max((" ".join(a), " ".join(c)), key=lambda t: tuple(minhash_dedup.digest(T.Words([t.encode()]).shingles(5)[0])))
    assert got[1][4][1] == (1 if big == " ".join(a) else 4) and got[1][5][1] == (5 if big == " ".join(a) else 4)


def test_cells_find_links_away_from_the_leader(spark):
    rng = random.Random(3)
    words = [word(rng) for _ in range(400)]
    chain = [" ".join(words[i:i + 200]) for i in range(0, 200, 20)]  # neighbours are linked, ends are not
    df = spark.createDataFrame([(i, t) for i, t in enumerate(chain)], "doc_id long, text string")
    assert {r.component_id for r in minhash_dedup.near_duplicates(df).collect()} == {0}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)] + [(5, 5), (200, 7)] + [(300, i) for i in range(301, 330)]
    got = components.components(spark.createDataFrame(edges, "u long, v long"), Staging(spark, "t"))
    proper = [e for e in edges if e[0] != e[1]]
    want = least_reachable({n for e in proper for n in e}, proper)
    assert {r.node: r.root for r in got.collect()} == want


def brute_removal(rows):
    out, where = [], {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for k in range(len(b) - 49):
                s = b[k:k + 50]
                where[s] = min(where.get(s, i), i)
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if i is not None and where[b[k:k + 50]] < i:
                gone[k:k + 50] = True
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return sorted(out, key=str)


def test_substring_removal(docs, rows, none):
    assert sorted(map(tuple, substring_exact.remove_repeats(docs).collect()), key=str) == brute_removal(rows)
    assert substring_exact.remove_repeats(none).count() == 0


def test_substring_removal_at_every_length(spark):
    rng = random.Random(5)
    s = "".join(rng.choice("ab") for _ in range(70))
    rows = [(1, s)] + [(k, "#" * k + s[:k] + "!" * k) for k in range(45, 71)] + [(80, s[10:60]), (81, s[11:60]), (82, (s + "-") * 9), (83, (s + "-") * 9), (83, s[:55])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, substring_exact.remove_repeats(df).collect()), key=str) == brute_removal(rows)


def test_containment(spark, docs, rows, none):
    rng = random.Random(9)
    longest = dict((i, t) for i, t in rows if i is not None)
    part = " ".join(longest[56].split()[500:540])
    near = part.split()
    near[3] = near[36] = "changed"
    items = [(1, part), (2, " ".join(near)), (3, prose(rng, 40)), (4, None), (5, ""), (6, "one two three"), (None, part),
             (7, " ".join(word_list(longest[30])[:12])), (7, prose(rng, 30))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, t in rows:
        for i, q in items:
            s = shingle_set(q)
            c = len(s & shingle_set(t))
            if d is not None and s and 100 * c >= 75 * len(s):
                want.add((d, i, len(s), c))
    got = decontaminate.find(docs, bench)
    assert {(r.doc_id, r.item_id, r.n_item, r.n_found) for r in got.collect()} == want
    kept = decontaminate.without_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(rows) - len({w[0] for w in want})
    assert decontaminate.find(none, bench).count() == 0
    assert decontaminate.find(docs, bench.limit(0)).count() == 0


PII = [
    "mail a.b+c@x-y.co.uk, or q@w now", "a@b.c_d@e.f", "a@b..c x@y.z.", "1.2.3.4.5.6.7.8 300.1.1.1 01.002.3.255",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 12345", "4111  1111 1111 1111", "call +1 (743) 555-3824. +12 +1-----2",
    "\x01\x02\x03 a@b.cd \x05 10.0.0.1\x02", "é@b.cd ñ1.1.1.1ñ", "DE89370400440532013000 and GB82WEST12345698765432 not DE00370400440532013000",
    "a@" * 3000 + "b.c" + ".d" * 3000, "9" * 20000, "1 " * 9000, "+1" + "(" * 5000 + "2", "x@y.z " * 700, None, "", "@", "+", "a@b.c@d.e",
    "4111111111111111@b.cd +4111111111111111"]


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def test_personal_data(spark, none):
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(PII)] + [(None, "a@b.cd", "k")], "doc_id long, text string, score string")
    only = {"email": lambda m: True, "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
            "card": lambda m: 16 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m)),
            "phone": lambda m: 8 <= len(re.sub(r"\D", "", m)) <= 15}
    pattern = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
               "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    got = {r.doc_id: r for r in pii.detect(df).collect()}
    for i, t in [*enumerate(PII), (None, "a@b.cd")]:
        told = []
        for kind in pii.BASE:
            found = [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern[kind], t or "") if only[kind](m.group())]
            assert got[i][f"n_{kind}"] == len(found), (i, kind)
            told += found
        assert got[i].base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest(), i
        assert got[i].spans.split(",")[: len(told)] == (told or got[i].spans.split(",")[:0])
    assert got[9].n_iban == 2
    assert got[4].scores[0].score > pii.CHECKED["card"]
    assert pii.detect(none).count() == 0


def test_redaction(spark):
    rows = [(1, "a.b@c.de at 1.2.3.4, v1.2 x-y.z 12 34-5; 4111 1111-1111 1111", 5), (2, None, 9), (3, "plain.text", 1), (4, "", 0),
            (5, "4111111111111111@b.cd end", 1), (6, "pay DE89 3704 0044 0532 0130 00 NOW, GB82 WEST 1234 5698 7654 32.", 1),
            (7, "FR14 2004 1010 0505 0001 3M02 606 DE88 3704 0044 0532 0130 00 DE89370400440532013000", 1),
            (8, "+4111111111111111 \x01\x03 ü1.2.3.4ñ +1 (743) 555-3824@b.cd", 1), (None, "x@y.zz", 1), (9, "a@b.cd " * 700, 1), (9, "a@b.cd", 1)]
    df = spark.createDataFrame([(*r, "k", "m") for r in rows], "doc_id long, text string, n_chars long, _text string, _row string")
    out = pii.redact(df)
    assert out.columns == df.columns
    got = [(r.doc_id, r.text, r.n_chars, r._text, r._row) for r in out.collect()]
    want = []
    for i, t, n in rows:
        spans = sorted((int(a), -int(b), pii.KINDS.index(k)) for k, a, b in (
            x.split(":") for x in pii.detect(df.where(F.col("text").eqNullSafe(F.lit(t)))).first().spans.split(",") if x))
        new, at = "", 0
        for a, b, k in spans:
            if a >= at:
                new += t[at:a] + f"<{pii.KINDS[k].upper()}>"
            at = max(at, -b)
        want.append((i, new + t[at:], len(new + t[at:]), "k", "m") if spans else (i, t, n, "k", "m"))
    assert sorted(got, key=str) == sorted(want, key=str)
    by = {r[0]: r[1] for r in got}
    assert by[1] == "<EMAIL> at <IP>, v1.2 x-y.z 12 34-5; <CARD>" and by[5] == "<EMAIL> end"
    assert by[6] == "pay <IBAN> NOW, <IBAN>." and by[7].startswith("<IBAN> ") and by[7].endswith(" <IBAN>")


def test_languages(spark, none):
    rng = random.Random(2)
    sounds = {"aa": ["ka", "ro", "mi", "ta"], "bb": ["schu", "zen", "grf", "ott"], "cc": ["ñe", "çá", "ölo", "éi"]}

    def text(lang, n):
        return " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))

    train = [(i, text(la, 60), la) for i, la in enumerate(list(sounds) * 20)] + [(900, None, "aa"), (901, "x", None), (902, "", "dd")]
    filters = language.train(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    asked = [(i, text(la, 25), la) for i, la in enumerate(list(sounds) * 10)]
    edge = [(100, None, "aa"), (101, "", "aa"), (102, "12 ;;", "aa"), (103, "漢字", None), (None, "k", None), (104, text("bb", 40_000), "bb")]
    df = spark.createDataFrame([(*r, 0.3, "old") for r in asked + edge], "doc_id long, text string, lang string, score double, lang_pred string")
    got = {r.doc_id: r for r in language.predict(df, filters).collect()}
    assert all(got[i].lang_pred == la and 0 <= got[i].score <= 1 for i, _, la in asked)
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[104].lang_pred == "bb"
    assert got[103].lang_pred in sounds and got[None].lang_pred in {*sounds, "dd"}
    nothing = language.train(none)
    assert {r.lang_pred for r in language.predict(df, nothing).collect()} == {"und"}
    assert language.predict(none, filters).count() == 0


def test_quality(spark, none):
    rng = random.Random(4)
    good = [(i, prose(rng, rng.randint(20, 150)), 1) for i in range(0, 120)]
    bad = [(i, "\n".join(" ".join(word(rng).upper() + "!!" for _ in range(8)) for _ in range(rng.randint(1, 12))), 0) for i in range(120, 200)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in good + bad if i % 2] + [(None, 1, 0), (7000, 0, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    field = quality.train(docs, labels)
    edge = spark.createDataFrame([(500, None), (501, ""), (502, "\n\n"), (None, "x"), (503, prose(rng, 20_000)), (503, "A!! B!!")], "doc_id long, text string")
    got = quality.score(docs.union(edge), field).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 206 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert sum(by[i].predicted == q for i, _, q in good + bad if i % 2 == 0) >= 97
    assert by[500].score == by[501].score == by[502].score == pytest.approx(field.prior)
    assert quality.keep_good(docs, field).columns == ["doc_id", "text"]
    lines = quality.label_lines(docs.where("doc_id >= 120"), field)
    assert {r.label for r in lines.collect()} == {"bad"}
    empty = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, empty).collect()} == {0.5} and quality.score(none, field).count() == 0


def test_line_marginals_against_all_labellings():
    rng = np.random.default_rng(0)
    size = np.array([3, 1, 5])
    first, p, stay = np.array([0, 3, 4]), rng.normal(size=9), 0.7
    good, equal, z = quality.chain(p, first, size, stay)
    at = 0
    for s, (a, n) in enumerate(zip(first, size, strict=True)):
        weights = {y: sum(p[a + k] for k in range(n) if y >> k & 1) + stay * sum((y >> k & 1) == (y >> k + 1 & 1) for k in range(n - 1)) for y in range(1 << n)}
        total = sum(np.exp(w) for w in weights.values())
        assert z[s] == pytest.approx(np.log(total))
        for k in range(n):
            assert good[a + k] == pytest.approx(sum(np.exp(w) for y, w in weights.items() if y >> k & 1) / total)
        for k in range(n - 1):
            assert equal[at] == pytest.approx(sum(np.exp(w) for y, w in weights.items() if (y >> k & 1) == (y >> k + 1 & 1)) / total)
            at += 1


def test_packing_shares_out_rows_without_id(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARE", 50)
    rows = [(None, "w " * (k % 7)) for k in range(300)] + [(3, "same")] * 200
    made = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).toPandas()
    assert len(made) == 500 and (made["sequence_id"] // (1 << 32)).value_counts().max() < 100


def test_packing(docs, rows, none):
    from tokenizers import Tokenizer

    made = packing.pack(docs, keep_ids=True).toPandas()
    whole = Tokenizer.from_file(packing.tokenizer_path())
    want = sorted(whole.encode(t or "", add_special_tokens=False).ids + [1] for _, t in rows)
    pieces = made.assign(doc_id=made["doc_id"].fillna(-1))
    got = []
    for i, g in pieces.groupby("doc_id"):
        if i == -1:  # two rows without id
            assert set(g["doc_tokens"]) == {1, len(whole.encode(rows[0][1], add_special_tokens=False).ids) + 1}
            continue
        g = g.sort_values("start")
        assert (g["start"] == g["length"].cumsum() - g["length"]).all()
        got.append([int(x) for part in g["ids"] for x in part])
    assert sorted(got) == sorted(w for w, (i, _) in zip([whole.encode(t or "", add_special_tokens=False).ids + [1] for _, t in rows], rows, strict=True) if i is not None)
    assert len(want) == len(rows)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in made.itertuples())
    for _, g in made.sort_values("offset").groupby("sequence_id"):
        assert (g["offset"] == g["length"].cumsum() - g["length"]).all() and g["length"].sum() <= packing.CAPACITY
    assert packing.pack(none).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 31, 500, 1023, 1024, 1025, 2047, 2048, 2049, 100_003])
def test_cuts_fill_their_classes(n):
    parts = packing.cuts(n)
    assert sum(parts) == n
    assert all(packing.CAPACITY // p * p >= packing.CAPACITY * (1 - packing.SLACK) - packing.CAPACITY // p for p in parts)


def test_fuzzy_passages(spark, none):
    rng = random.Random(11)
    passage = [word(rng) for _ in range(80)]
    edited = list(passage)
    edited[20], edited[50:52] = "zz", []
    texts = {1: prose(rng, 90).split() + passage + prose(rng, 30).split(), 2: prose(rng, 40).split() + edited + prose(rng, 70).split(),
             3: prose(rng, 200).split(), 4: passage, 5: prose(rng, 20_000).split()[:9_000] + passage}
    rows = [(i, " ".join(w)) for i, w in texts.items()] + [(6, None), (7, ""), (None, " ".join(passage)), (8, "a b"), (4, " ".join(passage))]
    got = chain_dedup.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r.doc_id: r for r in got}
    assert set(found) == {2, 4, 5} and all(r.src_doc_id == 1 for r in got)
    assert (found[2].start_word, found[2].end_word, found[2].src_start_word, found[2].src_end_word) == (40, 118, 90, 170)
    assert found[2].n_equal == 77 and found[4].identity == 1 and found[5].start_word == 9_000
    assert chain_dedup.fuzzy_passages(none).count() == 0


def test_fuzzy_passages_with_seeds_of_many_holders(spark):
    rng = random.Random(12)

    def words(n):
        return [word(rng) for _ in range(n)]

    p1, p2, p, q, gap = words(25), words(25), words(45), words(45), words(60)
    texts = {1: words(30) + p1 + words(30), 2: words(30) + p2 + words(30), 8: words(20) + p1 + p2 + words(20),
             9: words(50) + p1 + p2 + words(9),
             20: p[:22] + words(480) + p + words(20), 21: words(60) + p + words(7),
             30: q + gap + p[::-1], 31: words(5) + q + words(60) + p[::-1]}
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    got = {(r.doc_id, r.src_doc_id, r.start_word, r.end_word, r.src_start_word) for r in chain_dedup.fuzzy_passages(frame).collect()}
    assert got == {(9, 8, 50, 100, 20), (21, 20, 60, 105, 502), (31, 30, 5, 50, 0), (31, 30, 110, 155, 105)}


@pytest.mark.parametrize("n", [60, 100])
def test_fuzzy_passages_with_many_edits(spark, n):
    rng, rows, want = random.Random(n), [], set()
    for k, every in enumerate([9, 10, 11, 12] * 5):
        passage = [word(rng) for _ in range(n)]
        edited = [w + "zz" if i % every == every - 1 else w for i, w in enumerate(passage)]
        rows += [(k, prose(rng, 50) + " " + " ".join(passage)), (100 + k, " ".join(edited) + " " + prose(rng, 50))]
        want.add((100 + k, k))
    got = chain_dedup.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.src_doc_id) for r in got} == want
    assert all(r.end_word - r.start_word >= n - 12 for r in got)


def test_chain_is_the_best_one():
    rng = random.Random(1)
    for _ in range(30):
        pts = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(8)})
        x, y = np.array([p[0] for p in pts]), np.array([p[1] for p in pts])
        best = [float(chain_dedup.K)] * len(pts)
        for i in range(len(pts)):
            for j in range(i):
                if x[j] < x[i] and y[j] < y[i]:
                    best[i] = max(best[i], best[j] + chain_dedup.K - chain_dedup.GAP_COST * (x[i] - x[j] + y[i] - y[j]))
        top = chain_dedup.chains(x, y)[0]
        score = chain_dedup.K * len(top) - chain_dedup.GAP_COST * (x[top[-1]] - x[top[0]] + y[top[-1]] - y[top[0]])
        assert score == pytest.approx(max(best))


def test_nearest(spark):
    rng = np.random.default_rng(3)
    vec = rng.normal(size=(900, 8))
    vec[100:400] = vec[100]  # a hot vector
    rows = [(i, [float(x) for x in v], 1.0) for i, v in enumerate(vec)]
    odd = [(2000, None, 1.0), (2001, [0.0] * 8, 1.0), (2002, [1.0, None] + [0.0] * 6, 1.0), (2003, [float("nan")] * 8, 1.0),
           (2004, [float("inf")] + [0.0] * 7, 1.0), (None, [1.0] * 8, 1.0), (2005, [1.0], 1.0), (2006, [], 1.0), rows[40]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, score double")
    got = permutation_index.nearest(df, lambda c: c % 20 == 0).toPandas()
    hit = 0
    for q in range(0, 900, 20):
        g = got[got.query_id == q].sort_values("rank")
        s = (vec * vec[q]).sum(axis=1)
        want = [i for i in np.lexsort((np.arange(900), -np.round(s, 12))) if i != q][:20]
        assert list(g["rank"]) == list(range(1, 21)) and q not in set(g.vec_id)
        assert np.allclose(g.score, s[g.vec_id]) and (np.diff(g.score) <= 1e-12).all()
        hit += len(set(want) & set(g.vec_id))
    assert hit / (45 * 20) >= 0.9
    few = permutation_index.nearest(df.where("vec_id in (0, 1, 2)"), lambda c: c % 20 == 0).collect()
    assert {r.vec_id for r in few} == {1, 2}
    assert permutation_index.nearest(df.limit(0), lambda c: c % 20 == 0).count() == 0


def test_quotations(spark):
    rows = [
        (1, 0, "user", "Hello there\nHow ARE you?"), (1, 1, "bot", "> how are  you?\nFine."),
        (1, 2, "user", ">> Hello there How are you?\n> Fine.\nGood"), (1, 3, "bot", "> nothing like it\nWhat?"),
        (1, 4, "user", "> Good\nBye"), (1, 5, "bot", None), (1, 6, None, ""), (2, 0, "user", "> Hello there\nother"),
        (None, 3, "user", "> x\ny"), (1, None, "user", "z"), (1, 1, "bot", "> how are  you?\nFine."), (1, 7, "user", "long " * 20_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, parent_turn int")
    got = {(r.conv_id, r.turn): r for r in quotations.link(df).collect()}
    place = {k: (r.parent_turn, r.root_turn, r.depth, r.n_quoted, r.n_linked) for k, r in got.items()}
    assert place[1, 1] == (0, 0, 1, 1, 2) and place[1, 2] == (1, 0, 2, 2, 2)  # the repeated row links twice
    assert place[1, 3] == (None, 3, 0, 1, 0) and place[1, 4] == (2, 0, 3, 1, 1) and place[2, 0] == (None, 0, 0, 1, 0)
    assert place[None, 3] == (None, 3, 0, 1, 0) and place[1, None][0] is None
    assert got[1, 2].message == "<|user|>\nGood" and got[1, 6].message == "<|unknown|>\n" and got[1, 5].message == "<|bot|>\n"
    assert quotations.link(df).count() == len(rows) and quotations.link(df.limit(0)).count() == 0


def test_partial_quotations(spark):
    p1, p2, p3 = "One line here\nand a second\nand a third", "Other words. More of them! Last ones", "Third paragraph"
    rows = [
        (0, p1.split("\n")[0]), (1, f"{p1}\n\n{p2}\n\n{p3}"), (2, "> One line here\n> and a second\nyes"),
        (3, "> Other words. More of them! Last ones\n>\n> Third paragraph\nfine"), (4, "> More of them!\nso"),
        (5, "> More of\n> them! Last ones\nrewrapped"), (6, "> nowhere\n> and a third\nhalf"), (7, "> yes\nlate"), (8, "> never said\nno")]
    df = spark.createDataFrame([(1, i, "u", t) for i, t in rows], "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in quotations.link(df).collect()}
    assert {i: r.parent_turn for i, r in got.items()} == {0: None, 1: None, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 2, 8: None}
    assert [got[i].n_linked for i in range(9)] == [0, 0, 1, 1, 1, 1, 1, 1, 0]
    assert sorted(got, key=lambda i: got[i].position) == [0, 1, 2, 3, 4, 5, 6, 7, 8]
    assert sorted(r.position for r in got.values()) == list(range(9))


def test_long_reply_chain(spark):
    rows = [(1, 0, "u", "m0")] + [(1, i, "u", f"> m{i - 1}\nm{i}") for i in range(1, 40)]
    got = {r.turn: r.depth for r in quotations.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {i: i for i in range(40)}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(8)
    item = prose(rng, 40)
    good = [(i, prose(rng, 90)) for i in range(60)]
    docs = good + [(100, good[3][1]), (101, prose(rng, 30) + " " + item + " " + prose(rng, 30)), (102, prose(rng, 50) + " a@b.cd end")]
    docs += [(i, " ".join(word(rng).upper() + "!!" for _ in range(60))) for i in range(200, 240)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200), 0) for i, _ in docs], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert set(out.doc_id) == {*range(60), 102}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_duplicates", "benchmark_decontamination", "personal_data", "packing"]


def test_pipeline_keeps_the_token_ids(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    rng = random.Random(9)
    texts = {i: prose(rng, 60) for i in range(3)} | {3: prose(rng, 3_000), 4: "write to a@b.cd now"}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = corpus_pipeline.packed(spark, corpus_pipeline.personal_data(spark, frame, str(tmp_path)), str(tmp_path)).toPandas()
    whole = Tokenizer.from_file(packing.tokenizer_path())
    texts[4] = "write to <EMAIL> now"
    for doc, g in out.sort_values("start").groupby("doc_id"):
        assert [x for part in g["ids"] for x in part] == [*whole.encode(texts[doc], add_special_tokens=False).ids, packing.END]
    assert set(out.doc_id) == set(texts)


def test_batches_of_texts_are_bounded_by_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        staging.ship(spark)
        sizes = (spark.range(0, 60, 1, 1).selectExpr("repeat('x', 500000) as text")
                 .mapInPandas(lambda frames: (pd.DataFrame({"n": [int(f["text"].str.len().sum())]}) for f in frames), "n long").collect())
        assert sum(r.n for r in sizes) == 30_000_000 and max(r.n for r in sizes) < 10_000_000
        spark.conf.set(key, "12345678")
        staging.ship(spark)
        assert spark.conf.get(key) == "12345678"
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def test_known_parts_of_the_tokenizer_stay_in_arrays():
    encoder = packing.WordEncoder(packing.tokenizer_path())
    raw = [b"One two, three", b"two four one", b"", b"three five"]
    first = encoder.encode(raw[:1])
    later = encoder.encode(raw)
    assert [x.tolist() for x in later] == [encoder.plain(b.decode()).tolist() for b in raw] and (first[0] == later[0]).all()
    held = sum(x.nbytes for x in (encoder.names, encoder.begin, encoder.size))
    assert len(encoder.names) == 6 and held <= 6 * 24 and (np.diff(encoder.names.astype(object)) > 0).all()


def test_equal_first_identifiers_are_told_apart_by_the_second():
    g = pd.DataFrame({"h1": [4, 4, 4, 4], "h2": [1, 2, 1, 2], "doc_id": [9, 7, 8, 7], "span": 0, "cnt": 1, "need": 0})
    (out,) = substring_exact.answers("strings")(iter([g]))
    assert out["doc_id"].tolist() == [9]


def test_chains_of_one_line_are_those_of_the_tree(monkeypatch):
    rng = np.random.default_rng(4)
    for _ in range(200):
        x = np.sort(rng.choice(600, rng.integers(1, 40), replace=False))
        line = chain_dedup.chains(x, x + 7)
        # one match off the line, too far away to be in a chain of it, makes the tree look at all of them
        tree = chain_dedup.chains(np.append(x, 5000), np.append(x + 7, 9000))
        assert [c.tolist() for c in line] == [c.tolist() for c in tree if c.tolist() != [len(x)]]


def test_blocks_matched_are_those_of_difflib():
    rng = random.Random(6)
    for n in [0, 1, 3, 12, 40] * 40:
        a, b = ([rng.choice("abcdefgh"[: rng.randint(1, 8)]) for _ in range(rng.randint(0, n))] for _ in range(2))
        same = sum(m.size for m in SequenceMatcher(None, a, b, False).get_matching_blocks())
        assert chain_dedup.matched(a, b) == same


def test_a_chain_cut_in_parts_aligns_its_words_once(monkeypatch):
    """A gap that no identity can make up for is not aligned, others only once for all parts of a chain."""
    rng, asked, inner = random.Random(2), [], chain_dedup.matched
    monkeypatch.setattr(chain_dedup, "matched", lambda a, b: asked.append((len(a), len(b))) or inner(a, b))
    first, last = ([word(rng) for _ in range(60)] for _ in range(2))
    a = first + [word(rng) for _ in range(90)] + last
    b = first[:30] + [word(rng)] + first[30:] + [word(rng) for _ in range(15)] + last
    xs, ys = [0, 16, 40, 150, 200], [0, 16, 41, 76, 126]
    found = chain_dedup.passages(a, b, xs, ys)
    assert sorted((f[:4], f[4]) for f, _ in found) == [((0, 60, 0, 61), 60), ((150, 210, 76, 136), 60)]
    assert asked == [(24, 25)]


def test_runs_of_equal_identifiers_are_those_of_every_string():
    """Texts around the least length, empty ones among them, against one string after another."""
    rng = random.Random(8)
    for _ in range(60):
        raw = [bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 1, 25, 49, 50, 51, 75, 120]))) * rng.choice([1, 2]) for _ in range(6)]
        runs, expected = substring_exact.Runs(raw), []
        for i, t in enumerate(raw):
            for k in range(len(t) - substring_exact.WIDTH + 1):
                at = int(runs.offsets[i]) + k
                low = runs.gram[at : at + substring_exact.WIDTH - substring_exact.GRAM + 1].min() & substring_exact.LOW48
                if k and expected[-1][1] == at and expected[-1][3] == low:
                    expected[-1][1] = at + 1
                else:
                    expected.append([at, at + 1, i, low])
        assert [list(r) for r in zip(runs.start, runs.end, runs.text, runs.fp, strict=True)] == expected


def test_posts_hold_what_their_step_asks_for_only():
    frame = pd.DataFrame({"doc_id": [1, 2], "text": ["a few words that two documents share, fifty bytes long"] * 2})
    (posts,) = substring_exact.posting(substring_exact.initial_posts, "buckets")(iter([frame]))
    assert list(posts) == ["h1", "doc_id", "span", "cnt"]
    told = pd.concat(substring_exact.answers("buckets")(iter([posts.sort_values("h1")])))
    assert sorted(set(told["doc_id"])) == [1, 2]


def test_a_seed_leads_once_in_a_text():
    """The passes over the texts bring what they use only, for texts of any length."""
    line = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    frame = pd.DataFrame({"doc_id": [1, 2, 2, 3, 4], "text": [line * 3, line, line + "end", "", "short"]})
    every = pd.concat(chain_dedup.seeds(iter([frame])))
    assert list(every) == ["seed", "run", "doc_id", "copy", "pos"] and len(every)
    lead = pd.concat(chain_dedup.leads(iter([frame, frame.iloc[3:]])))
    expected = every.sort_values("pos").drop_duplicates(["seed", "doc_id", "copy"])[["seed", "doc_id", "pos"]]
    assert sorted(map(tuple, lead.to_numpy().tolist())) == sorted(map(tuple, expected.to_numpy().tolist()))
