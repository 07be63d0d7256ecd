"""Operators over the whole corpus: similarity join, divergence of sources, collocations."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import oracle
from conftest import SMALL
from tagloom.llm import catalog, collocations, divergence, jaccard

from .conftest import LONG, ODD

SQL, QUERIES = catalog.oracle_sql(), catalog.queries()


@pytest.mark.parametrize("name", ["op11_jaccard", "op12_divergence", "op13_collocations"])
def test_query_equals_its_sql(spark, name):
    assert oracle.differences(QUERIES[name](spark, SMALL), oracle.connect(SMALL), SQL[name]) == []


# Similarity join


def linked_components(texts: dict[int, str], shingle=4, least=85) -> dict[int, tuple[int, int]]:
    """Size and component of each text, by comparing every two sets."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = {" ".join(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set()
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed: int) -> dict[int, str]:
    """Texts with copies at all distances, a line that most of them hold, and clusters larger than a group."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    line = [word() for _ in range(12)]
    texts = []
    for size in (6, 20, 60, 150):
        for copies in (1, 1, 3, 12, 90):
            base = [word() for _ in range(size)]
            for _ in range(copies):
                own = list(base)
                for _ in range(rng.randrange(4)):
                    own[rng.randrange(size)] = word()
                if rng.random() < 0.2:
                    own = own[rng.randrange(4) :]
                texts.append(" ".join(line + own if rng.random() < 0.7 else own))
    texts += [" ".join(line), " ".join(line[:3]), " ".join(line[:3]).upper(), "", " \n"]
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_equals_brute_force(make, seed):
    texts = near_copies(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(make(list(texts.items()))).collect()}
    assert got == linked_components(texts)


def test_jaccard_holds_with_full_groups_and_crowded_tokens(make, monkeypatch):
    """Small groups, few known crowded tokens and many salts change how it is found, not what."""
    texts = near_copies(3)
    for name, value in (("MEMBERS", 3), ("CROWD", 2), ("MOST_CROWDED", 20), ("QUERIES", 2)):
        monkeypatch.setattr(jaccard, name, value)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(make(list(texts.items()))).collect()}
    assert got == linked_components(texts)


@pytest.mark.parametrize("least", [50, 85, 100])
def test_first_tokens_share_what_they_must(least):
    """Of two sets that just reach the bound, the first tokens have the promised number in common, in any order."""
    rng = random.Random(least)
    for _ in range(400):
        small = rng.randrange(1, 120)
        large = rng.randrange(small, -(-100 * small // least) + 1)
        common = -(-least * (small + large) // (100 + least))
        if common > small:
            continue
        shared = list(range(common))
        a, b = shared + [-i - 1 for i in range(large - common)], shared + [1000 + i for i in range(small - common)]
        rank = {t: rng.random() for t in {*a, *b}}
        asked = [rng.randrange(1, jaccard.most_shared(n) + 1) for n in (large, small)]
        query = set(sorted(a, key=rank.get)[: jaccard.query_length(large, least, asked[0])])
        listed = set(sorted(b, key=rank.get)[: jaccard.matrix_length(small, least, asked[1])])
        assert len(query & listed) >= min(asked)
        assert jaccard.most_shared(small) >= 1 + -(-least * large // 100) // jaccard.SHARED_EACH


def test_jaccard_odd_inputs(odd, nothing):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_documents(odd).collect()}
    assert got == {
        (None, 5, None), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 4, 5), (6, 4, 5), (7, 1, 7), (8, len(LONG.split()) - 3, 8), (9, 4, 9),
    }
    assert jaccard.similar_documents(odd).count() == len(ODD)
    assert jaccard.similar_documents(nothing).count() == 0


def test_jaccard_null_id_never_names_a_component(make):
    rows = [(None, "one two three four five"), (7, "one two three four five"), (9, "ONE two three\nfour five")]
    assert {r.component_id for r in jaccard.similar_documents(make(rows)).collect()} == {7}


# Divergence of sources


def test_skyband_is_that_of_all_pairs():
    rng = np.random.default_rng(5)
    for n, k in ((0, 3), (1, 1), (700, 1), (1500, 5), (1500, 50)):
        count, overall, name = rng.integers(0, 40, n), rng.integers(0, 40, n), rng.permutation(n)
        over = (count[None] >= count[:, None]) & (overall[None] <= overall[:, None]) & (name[None] < name[:, None])
        assert sorted(divergence.skyband(count, overall, name, k)) == np.flatnonzero(over.sum(axis=1) < k).tolist()


def audited(rows, least_docs, top):
    """The audit by plain counting."""
    used, kept = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = [t.decode() for t in divergence.terms(text or "")]
        used[lang or "", source or ""].update(found)
        kept[lang or ""].update(set(found))
    out = []
    for lang, source in used:
        terms = [t for t, n in kept[lang].items() if n >= least_docs]
        mine = {s: c for (l, s), c in used.items() if l == lang}
        overall = Counter()
        for c in mine.values():
            overall.update(c)

        def share(c):
            total = sum(c[t] for t in terms) + 5 * len(terms)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in terms}

        p, q = share(mine[source]), share(overall)
        pairs = [(s, sum(abs(p[t] - x) for t, x in share(c).items())) for s, c in mine.items() if s != source]
        best = [(t, p[t] - q[t]) for t in terms if mine[source][t] and p[t] > q[t]]
        for part, found, limit in (("pair", pairs, None), ("term", best, top)):
            ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit]
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def some_sources(spark, n=400):
    rng = random.Random(4)
    words = [f"{rng.choice('abcxyzéß')}{rng.choice('mn')}{i}é" for i in range(1)] + [a + b + c for a in "abcdefgé" for b in "xyzß" for c in "qrst"]
    rows = []
    for i in range(n):
        weights = [1 + (hash((j, i % 5)) % 7 if i % 3 else j % 4) for j in range(len(words))]
        text = rng.choice([", ", " ", "-3_"]).join(rng.choices(words, weights, k=rng.randrange(0, 40)))
        rows.append((rng.choice(["en", "en", "fr", None]), f"s{i % 5}" if i % 11 else None, text.title() if i % 2 else text))
    rows += [("xx", "only", "never kept"), ("xx", "other", None), ("yy", "alone", "")]
    return rows, spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)


@pytest.mark.parametrize("least_docs, top", [(30, 50), (5, 3), (1, 7)])
def test_audit_equals_plain_counting(spark, least_docs, top):
    rows, docs = some_sources(spark)
    got = sorted(tuple(r) for r in divergence.audit(docs, least_docs, top).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == audited(rows, least_docs, top)


def test_audit_in_small_parts(spark, monkeypatch):
    """Counts handed on early, many blocks of terms and many merges of skybands give the same."""
    rows, docs = some_sources(spark)
    for name, value in (("COUNTED", 50), ("BLOCK_TERMS", 7), ("MERGED", 1)):
        monkeypatch.setattr(divergence, name, value)
    got = sorted(tuple(r) for r in divergence.audit(docs, 3, 4).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == audited(rows, 3, 4)


def test_shares_are_exact_past_64_bits(spark):
    n, total, v = 3 * 10**12 + 1, 7 * 10**15 + 3, 123_457
    row = spark.createDataFrame([(n, total, v)], "n long, total long, v long").select(divergence.share(*map(divergence.F.col, ("n", "total", "v"))).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 5 * v)


def test_audit_odd_inputs(odd, nothing):
    rows = [(r.lang, r.source, r.text) for r in odd.withColumn("source", divergence.F.lit(None).cast("string")).select("lang", "source", "text").collect()]
    got = divergence.audit(odd.withColumn("source", divergence.F.lit(None).cast("string")), 1, 5)
    assert sorted(tuple(r) for r in got.select("lang", "source", "part", "item", "value", "rank").collect()) == audited(rows, 1, 5)
    assert divergence.audit(nothing.withColumn("source", divergence.F.lit("s"))).count() == 0


# Collocations


def mined(rows, least, longest, top, contained=100):
    """Collocations by plain counting."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, low = "und" if lang is None else lang, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for mark in ".,;:!?\n\v\f\r":
            low = low.replace(mark, "\n")
        for piece in low.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, found in counts.items():
        found = {p: f for p, f in found.items() if f >= least}
        longer = Counter()
        for p, f in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(longer[p[i : i + size]], f)
        scored = []
        for p, a in found.items():
            if len(p) > 1 and not 100 * longer[p] >= contained * a:
                score, _, left, right = min((1000 * a * totals[lang] // (found[p[:k]] * found[p[k:]]), k, found[p[:k]], found[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def some_phrases(spark, n=600):
    rng = random.Random(9)
    set_phrases = [["new", "york"], ["New", "York", "city"], ["a", "b", "a", "b", "a"], ["point", "of", "no", "return"], ["é", "ß", "北京"]]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(30)):
            words += rng.choice(set_phrases) if rng.random() < 0.3 else [rng.choice("the of a b c d é new".split())]
        rows.append((rng.choice(["en", "en", "de", None, "und"]), "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"]) for w in words)))
    rows += [("en", None), (None, ""), ("zz", " \t\n"), ("en", "stop" * 1000)]
    return rows, spark.createDataFrame(rows, "lang string, text string").repartition(6)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("sizes", [{}, {"shards": 3, "block_words": 500}, {"shards": 32, "block_words": 40}])
def test_collocations_equal_plain_counting(spark, sizes):
    """In one pass over blocks, and dealt to shards of many tasks."""
    rows, docs = some_phrases(spark)
    got = sorted(tuple(r) for r in collocations.collocations(docs, 20, 5, 40, **sizes).select(*COLUMNS).collect())
    assert got == mined(rows, 20, 5, 40) and len(got) > 60


def test_candidates_come_once_from_each_block_that_was_mined(spark, monkeypatch):
    """Not once from each of many tasks of the input."""
    rows, docs = some_phrases(spark)
    blocks, made = collocations._blocks, {}

    def counted(rows, each, schema, *sizes):
        out = blocks(rows, each, schema, *sizes)
        made[schema] = out.rdd.getNumPartitions(), out.count()
        return out

    monkeypatch.setattr(collocations, "_blocks", counted)
    found, _ = collocations.frequent_phrases(docs.repartition(40), 20, 5, shards=4, stored=True)
    tasks, emitted = made[collocations.COUNTED]
    assert tasks == 4 and emitted <= 4 * 2 * found.count()


def test_collocations_with_other_settings(spark):
    rows, docs = some_phrases(spark, 200)
    got = sorted(tuple(r) for r in collocations.collocations(docs, 3, 3, 10**6, contained=60).select(*COLUMNS).collect())
    assert got == mined(rows, 3, 3, 10**6, 60)


def test_counts_do_not_rest_on_hashes():
    """Phrases of one hash are told apart by their words."""
    block = collocations.Block()
    block.add("en", 9, "a b c a b a c c c")
    (_, _, text), = block.languages()
    text.h = np.zeros_like(text.h)
    assert Counter(dict(text.counted())) == Counter({b"a": 3, b"b": 2, b"c": 4})


@pytest.mark.parametrize("least, parts", [(100, [7, 50, 43]), (3, [1, 1, 98]), (1, [5, 5])])
def test_some_shard_reaches_its_support(least, parts):
    total = sum(parts)
    below = [collocations.support(least, part, total) - 1 for part in parts]
    assert sum(below) < least


def test_collocations_odd_inputs(odd, nothing):
    rows = [(r.lang, r.text) for r in odd.collect()]
    got = sorted(tuple(r) for r in collocations.collocations(odd, 2, 5, 50).select(*COLUMNS).collect())
    assert got == mined(rows, 2, 5, 50) and got
    assert collocations.collocations(nothing).count() == 0
    assert collocations.collocations(odd, 10**6).count() == 0
