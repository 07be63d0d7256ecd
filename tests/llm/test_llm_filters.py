"""Toxicity, decontamination, URL filters and personal data."""

from __future__ import annotations

import hashlib
import re
import zlib
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.llm import catalog, decontaminate, pii, toxicity, url_filters
from tagloom.llm.fuzzy_lexicon import FuzzyLexicon

from conftest import plan


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, x, b, i)
    return row[-1]


def _next(row, x, b, i):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
    return out


def swapped_distance(a, b):
    """Edits where two letters beside each other may be swapped."""
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=9))
def test_lexicon_equals_edit_distances(word):
    stems = {"abc": 1.0, "abcab": 2.0, "bcbcb": 3.0, "cabcabcab": 4.0}
    got = FuzzyLexicon(stems).match(word)
    near = [
        (d, -w) for s, w in stems.items() for k in range(1, len(word) + 1)
        if (d := swapped_distance(word[:k], s)) <= (len(s) >= 5) + (len(s) >= 9)
    ]
    assert got == ((-min(near)[1], min(near)[0]) if near else None)


def test_context_tells_quotation_from_abuse():
    scorer = toxicity.Scorer({"idiot": 5.0})
    abuse, quoted = scorer.features("you are such an idiot today"), scorer.features('he said the word "idiot" was wrong')
    assert abuse[0] > 0 and abuse[1] == 0
    assert quoted[0] == 0 and quoted[1] > 0
    assert 0 < scorer.features("you are such an idiiot today")[0] < abuse[0] and scorer.features("")[0] == 0


def test_misspelled_terms_count_less_but_for_toxicity():
    scorer = toxicity.Scorer({"stupid": 7.0, "worthless": 7.4, "weak": 3.0}, words={"oaf": 6.0}, known=frozenset({"stupi"}))
    scorer._hits()
    whole = scorer._hit("stupid")
    assert whole == (7.0, 0) and scorer._hit('"stupidly",') == whole
    for token in ("st*pid", "stuipd", "stupd", "sttupid", "(stup!d)", "st-upid"):
        weight, edits = scorer._hit(token)
        assert edits == 1 and 2.5 <= weight < 7.0, token
    assert scorer._hit("wrthles")[1] == 2 and scorer._hit("oaf") == (6.0, 0)
    # A known spelling, a stem whose odds do not bear an edit, a short word that is part of another.
    assert scorer._hit("stupi") is None and scorer._hit("weka") is None and scorer._hit("oafs") is None


@pytest.fixture(scope="module")
def scored(spark):
    return catalog.op2_toxicity(spark, "/root/testdata/sf0.01").cache()


def test_toxicity_on_held_out_rows(spark, scored):
    rows = scored.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    toxic, clean = [r.score for r in held if r.toxic], [r.score for r in held if not r.toxic]
    assert sum(a > b for a in toxic for b in clean) / (len(toxic) * len(clean)) > 0.95
    assert scored.count() == 1000


def test_misspelled_copies_of_toxic_texts_are_caught(spark):
    """Held-out toxic texts with an edit in each of their terms; the clean ones stay clean."""
    import random

    rng, folder = random.Random(3), "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scorer = toxicity.learn(docs, labels)
    scorer._hits()

    def misspell(token):
        hit = scorer._hit(token.lower())
        if not hit or hit[1] or len(token) < 5 or not token.isalpha():
            return token
        i = rng.randrange(1, 4)
        return rng.choice([token[:i] + token[i + 1 :], token[:i] + token[i] + token[i:], token[:i] + "*" + token[i + 1 :], token[:i] + token[i + 1] + token[i] + token[i + 2 :]])

    rows = [r for r in docs.join(labels, "doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    caught = [scorer.score(r.text) >= 0.5 for r in rows if r.toxic]
    again = [scorer.score(" ".join(map(misspell, r.text.split(" ")))) >= 0.5 for r in rows if r.toxic]
    assert sum(again) >= 0.8 * sum(caught) > 0
    assert sum(scorer.score(r.text) >= 0.5 for r in rows if not r.toxic) <= 0.02 * len(rows)


def test_toxicity_learns_nothing_from_held_out_rows(spark, make):
    rows = [(i, ("good words here " if i % 2 else "vile zorgon words ") * 3 + f"x{i}") for i in range(200)]
    labels = spark.createDataFrame([(i, 0, 1 - i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    docs = make(rows)
    held = toxicity.held_out(F.col("doc_id"))
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.learn(docs, x) for x in (labels, other))
    assert a.stems == b.stems and a.weights == b.weights and any(s.startswith("zorg") for s in a.stems)


def test_toxicity_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scorer = toxicity.learn(odd, labels)
    assert {r.score for r in toxicity.score_documents(odd, scorer).collect()} == {0.0}
    assert toxicity.drop_toxic(odd, scorer).columns == odd.columns
    marked = spark.createDataFrame([(i, 0, i % 2) for i in range(10)] + [(None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    scorer = toxicity.learn(odd, marked)
    assert toxicity.score_documents(odd, scorer).count() == odd.count()
    assert toxicity.score_documents(nothing, scorer).count() == 0


ITEM = "A train leaves Boston at 9 km per hour and Alice waits there for 12 minutes before the train stops near Boston again."


def leaks(docs, spark, items=((1, ITEM),)):
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return {(r.doc_id, r.item_id): r.changed for r in decontaminate.find_leaks(docs, bench).collect()}


def test_reparameterised_items_are_found_and_inconsistent_ones_are_not(spark, make):
    changed = ITEM.replace("Boston", "Lisbon").replace("Alice", "Maria").replace("9", "40").replace("12", "7.5")
    mixed = ITEM.replace("Boston", "Lisbon", 1)
    docs = make([
        (1, f"some words before. {ITEM} and some after"),
        (2, f"before. {changed} after"),
        (3, f"before. {mixed} after"),
        (4, "A train leaves early and nothing else is told here."),
        (5, ITEM.upper()),
        (6, ITEM.replace("minutes", "hours")),
    ])
    got = leaks(docs, spark)
    assert got[1, 1] is False and got[2, 1] is True and got[6, 1] is True
    assert (3, 1) not in got and (4, 1) not in got


def test_leaks_equal_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))

    def windows(text):
        words = re.findall(r"[^\W\d_]+", text.lower())
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    items = {r.item_id: windows(r.text) for r in bench.collect()}
    want = set()
    for r in docs.collect():
        have = windows(r.text)
        want |= {(r.doc_id, i) for i, w in items.items() if w and len(w & have) >= 0.8 * len(w)}
    found = catalog.op4_decontaminate(spark, folder).collect()
    assert want and {(r.doc_id, r.item_id) for r in found} == want
    assert not any(r.changed for r in found)


def test_leaks_of_odd_rows(spark, odd, nothing, make):
    odd_items = [(1, None), (2, ""), (3, "too short item"), (None, ITEM), (None, ITEM), (4, ITEM)]
    got = leaks(make([(None, ITEM), (None, ITEM), (7, ITEM), (8, None)]), spark, odd_items)
    assert set(got) == {(None, None), (None, 4), (7, None), (7, 4)}
    assert leaks(odd, spark, odd_items) == {} and leaks(nothing, spark) == {}
    assert leaks(odd, spark, ()) == {}
    bench = spark.createDataFrame(odd_items, "item_id long, text string")
    kept = decontaminate.drop_leaks(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count()


NAMED = "When Anna met Omar in Lisbon, Maria gave Peter 3 books that Oscar wrote."


def test_copies_in_other_case_are_found(spark, make):
    docs = make([
        (1, f"before. {NAMED.lower()} after"), (2, NAMED.upper()), (3, "So: " + NAMED.title()), (4, NAMED.lower().replace("3", "17")),
        (5, NAMED.replace("Maria", "Helen")), (6, NAMED.replace("Omar", "Anna")), (7, "when anna met nobody in lisbon, nothing came of it at all."),
    ])
    assert leaks(docs, spark, [(1, NAMED)]) == {(1, 1): False, (2, 1): False, (3, 1): False, (4, 1): True, (5, 1): True}
    bench = spark.createDataFrame([(1, NAMED)], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.drop_leaks(docs, bench).collect()} == {6, 7}


def test_short_items_are_found(spark, make):
    items = [(1, "What is 2 + 2?"), (2, "What is the capital of France?"), (3, "in 1990"), (4, "Oxygen"), (5, "What does Anna eat daily?")]
    docs = make([
        (1, "He asked: What is 2 + 2? Nobody knew."), (2, "WHAT IS 2 + 2"), (3, "and then, what is 3 + 3?"), (4, "what is 2 + 3?"),
        (11, "Question: What is the capital of France?"), (12, '"What is the capital of Spain"'), (13, "Geography\nWhat is the capital of France"),
        (21, "that was In 1990."), (22, "that was in 1991"), (31, "of oxygen there is much"), (41, "Say: What does Maria eat daily?"), (51, "What is this"),
    ])
    want = {(1, 1): False, (2, 1): False, (3, 1): True, (11, 2): False, (12, 2): True, (13, 2): False, (21, 3): False, (31, 4): False, (41, 5): True}
    assert leaks(docs, spark, items) == want


def test_template_steps_are_not_repeated_per_word(spark, make):
    frame = decontaminate._windowed(make([(1, "a b c d e f")]).select("doc_id", "text"), 5, "doc_id", short=[])
    text = plan(frame)
    assert text.count("regexp_extract_all") == 2 and "Python" not in text


def judged(spark, captures, entries):
    c = spark.createDataFrame(captures, "page_id long, url string, fetched date")
    e = spark.createDataFrame(entries, "list string, pattern string, action string, date date")
    return {r.capture_id: r for r in url_filters.judge(c, url_filters.intervals(e)).collect()}


def test_captures_are_judged_by_the_list_of_their_day(spark):
    entries = [
        ("block", "bad.example.com", "add", date(2024, 1, 10)), ("block", "bad.example.com", "remove", date(2024, 3, 1)),
        ("block", "bad.example.com", "add", date(2024, 5, 1)), ("block", "example.org", "add", date(2024, 1, 1)),
        ("allow", "x.example.org/ok", "add", date(2024, 2, 1)), ("block", "tie.com", "add", date(2024, 1, 1)), ("block", "tie.com", "remove", date(2024, 1, 1)),
        ("block", None, "add", date(2024, 1, 1)), ("block", "nodate.com", "add", None), ("block", "odd.com", "what", date(2024, 1, 1)),
    ]
    url = "https://www.Bad.example.com:80/a/b?c"
    captures = [
        (1, url, date(2024, 1, 9)), (2, url, date(2024, 1, 10)), (3, url, date(2024, 2, 29)), (4, url, date(2024, 3, 1)), (5, url, date(2026, 1, 1)),
        (6, "http://x.example.org/ok/page", date(2024, 1, 15)), (7, "http://x.example.org/ok/page", date(2024, 2, 15)), (8, "http://x.example.org/okay", date(2024, 2, 15)),
        (9, None, date(2024, 2, 1)), (10, "no url", date(2024, 2, 1)), (11, url, None), (12, "http://tie.com/", date(2024, 1, 1)), (12, "http://tie.com/", date(2024, 1, 1)),
        (13, "http://notexample.org/", date(2024, 2, 1)),
    ]
    got = judged(spark, captures, entries)
    assert {k for k, r in got.items() if r.blocked} == {2, 3, 5, 6, 8}
    assert {k for k, r in got.items() if r.allowed} == {7}
    assert got[5].listed_since == date(2024, 5, 1) and got[5].pattern == "bad.example.com"


def test_patterns_are_compared_as_urls_are(spark):
    day = date(2024, 1, 1)
    entries = [("block", p, "add", day) for p in ("Example.com/Path", "www.Host.org", "WWW.both.net/A/b", "plain.com")]
    urls = ["http://example.com/Path", "http://example.com/path", "https://www.host.org/x", "http://sub.host.org/", "http://www.both.net/A/b/c", "http://both.net/a/b", "http://PLAIN.com/", "http://wwwplain.com/"]
    got = judged(spark, [(i, u, day) for i, u in enumerate(urls)], entries)
    assert {i for i, r in got.items() if r.blocked} == {0, 2, 3, 4, 6}


def test_url_filters_of_empty_tables(spark):
    assert judged(spark, [], [("block", "a.com", "add", date(2024, 1, 1))]) == {}
    assert not judged(spark, [(1, "http://a.com/", date(2024, 1, 1))], [])[1].blocked


# The base patterns as stated, for comparison.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))) % 10 == 0


def stated_spans(text):
    out = []
    for kind, pattern in STATED.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")), "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TRICKY = [
    "a@b.c@d.e", "a@b.cd%x@y.z", "x..@-.-", "@a.b", "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.1.1.1", "001.002.003.0255", "4111 1111 1111 1111", "4111-1111-1111-1111x 4111--1111",
    "+1 (017) 555-7713", "+1", "+12+345 678 9012", "é4111111111111111é", "🙂 me@x.co.uk. 🙂 10.0.0.1,", "+1.2.3.4 12345678901234", "0" * 30, "5500005555555559 5500005555555559", "a" * 3000 + "@", "1" * 2000 + ".1",
]


def test_base_spans_equal_the_stated_patterns(make):
    texts = [*TRICKY, " ".join(TRICKY), None, ""]
    got = {r.doc_id: r for r in pii.summary(pii.find(make(list(enumerate(texts))))).collect()}
    for i, text in enumerate(texts):
        want = stated_spans(text)
        assert got[i].spans.split(",") == (want or [""]), text[:60] if text else text
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in STATED] == [sum(w.startswith(k + ":") for w in want) for k in STATED]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text("0123456789.+-()@ aé%\n", max_size=80), min_size=20, max_size=20))
def test_base_spans_of_random_texts(make, texts):
    found = pii.find_base(make(list(enumerate(texts))))
    rows = found.select("doc_id", pii.written(F.concat(*pii.KINDS)).alias("s")).collect()
    assert {r.doc_id: r.s for r in rows} == {i: ",".join(stated_spans(t)) for i, t in enumerate(texts)}


def test_contexts_reveal_unseen_identifiers(make):
    rows = [(i, f"noise {i % 7} then mail user{i}@host{i}.example.com please") for i in range(12)]
    rows += [(100, "noise then mail someone-at-host99 please"), (101, "version 123456789 of nothing")]
    got = {r.doc_id: r for r in pii.summary(pii.find(make(rows))).collect()}
    assert got[100].n_added == 1 and got[100].spans == "email:16:33" and got[100].n_email == 0
    assert got[101].n_added == 0 and all(got[i].n_email == 1 for i in range(12))


UNSEEN = ["030 1234567", "(555) 123-4567", "555-123-4567", "0171 22 33 444"]


def test_unseen_forms_are_found_where_they_are_common(make):
    """More unseen than typed instances in a context, with blanks and brackets; other contexts hold numbers of all sorts."""
    rows = [(i, f"call tel: +49 30 {1000000 + i} now. see page {i} of v{i}.{i}.{i}x and 2024-01-{10 + i}") for i in range(8)]
    rows += [(100 + i, f"my tel: {UNSEEN[i % 4][:-1]}{i % 9} is new, order 20{i}-33-1{i} of 123{i}4567 items") for i in range(16)]
    got = {r.doc_id: r for r in pii.find(make(rows)).collect()}
    texts = dict(rows)
    found = [[(s.kind, texts[i][s.start : s.end]) for s in got[i].added] for i in range(100, 116)]
    assert sum(f == [("phone", texts[100 + k].split("tel: ")[1].split(" is")[0])] for k, f in enumerate(found)) >= 15
    assert all(not got[i].added and [s.kind for s in got[i].base] == ["phone"] for i in range(8))


def scored_patterns(occurrences, least_support, rounds, least_score):
    """Scores of patterns by plain loops, from ``(patterns, kind or '', value, unseen kinds)``."""
    accepted = {}
    for i in range(rounds):
        typed, loose = {}, {}
        for words, kind, value, kinds in occurrences:
            for w in words:
                for k, s in [(kind, 1.0)] if kind else [(k, accepted[value, k]) for k in kinds if (value, k) in accepted]:
                    typed.setdefault(w, []).append((k, value, s))
                if not kind:
                    loose.setdefault(w, []).append(kinds)
        scores = {}
        for w, found in typed.items():
            total = sum(s for _, _, s in found)
            for k in {k for k, _, _ in found}:
                if len({v for kk, v, _ in found if kk == k}) >= least_support and (fitting := sum(k in kinds for kinds in loose.get(w, []))):
                    scores[w, k] = sum(s for kk, _, s in found if kk == k) / total * fitting / len(loose[w])
        accepted = {}
        for words, kind, value, kinds in occurrences:
            for k in kinds if not kind else []:
                best = max((scores.get((w, k), 0) for w in words), default=0)
                if best >= least_score:
                    accepted[value, k] = max(best, accepted.get((value, k), 0))
    return {key: s for key, s in scores.items() if s >= least_score}


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_pattern_scores_equal_plain_loops(make, rounds):
    import random

    rng = random.Random(7)
    make_value = {
        "email": lambda: f"a{rng.randrange(40)}@b{rng.randrange(9)}.org", "ip": lambda: f"10.0.{rng.randrange(9)}.{rng.randrange(255)}",
        "phone": lambda: f"+49 30 {rng.randrange(10**6, 10**7)}", "": lambda: rng.choice([f"030 {rng.randrange(10**4, 10**5)}", f"id-{rng.randrange(30)}x{rng.randrange(9)}z", f"{rng.randrange(10**6, 10**7)}", f"1.2.{rng.randrange(99)}.x"]),
    }
    favoured = {"tel:": ["phone", ""], "mail": ["email", ""], "at": ["ip", "", "email"], "the": list(make_value), "call tel:": ["phone", ""]}
    rows = []
    for i in range(300):
        before = rng.choice(list(favoured))
        rows.append((i, f"q {before} {make_value[rng.choice(favoured[before])]()} {rng.choice(['now', 'or later', 'then'])} q"))
    found = pii.find_base(make(rows)).cache()
    occurrences = []
    for r in found.collect():
        for s in [*r.email, *r.ip, *r.card, *r.phone, *r.loose]:
            digits, letters = sum(c.isdigit() for c in s.value), any(c.isalpha() for c in s.value)
            kinds = [k for k, (wanted, least, most, mark) in pii.FORMS.items() if letters == wanted and least <= digits <= most and mark in s.value]
            occurrences.append(([(side, " ".join(s[side].split())) for side in pii.SIDES if s[side]], s.kind, s.value, kinds))
    want = scored_patterns(occurrences, 3, rounds, 0.25)
    got = {((r.side, r.word), r.kind): r.score for r in pii.patterns(found, rounds, 0.25, 3).collect()}
    assert want and {k: pytest.approx(v) for k, v in want.items()} == got


def test_contexts_are_whole_words(make):
    long = "w" * 300
    (row,) = pii.find_base(make([(1, f"a {long}{' ' * 90}10.0.0.1{' ' * 90}{long} b")])).collect()
    assert (row.ip[0].before, row.ip[0].after, row.ip[0].after2) == (long, long, f"{long} b")


def test_personal_data_of_odd_rows(odd, nothing):
    rows = pii.summary(pii.find(odd)).collect()
    assert len(rows) == odd.count() and all(r.spans == "" for r in rows if r.doc_id in (1, 2, 3))
    assert pii.summary(pii.find(nothing)).count() == 0


def test_personal_data_runs_no_python(odd):
    text = plan(pii.find_base(odd))
    assert "Python" not in text and "Arrow" not in text
    assert text.count("regexp_extract_all(") == 5 and text.count("split(text") == 5


def test_places_in_a_text_of_very_many_matches(make):
    text = " ".join(["1.1.1.1"] * 3000)
    row = pii.summary(pii.find(make([(1, text)]))).first()
    assert row.n_ip == 3000 and row.spans == ",".join(stated_spans(text))


# Items asked again: names at the beginning of sentences, names of several words, number words, digit groups.
SCHOOL = "Anna has 5 red apples in a basket. Bob has 3 green apples in a box. Clara buys 4 apples. How many apples do they have in all?"
ASKED_AGAIN = [
    (SCHOOL, "Mary has 7 red apples in a basket. John has 9 green apples in a box. Susan buys 2 apples. How many apples do they have in all?"),
    ("Anna Smith sold 12 boxes of tea to a shop and then kept the other boxes for herself.", "Bob sold 40 boxes of tea to a shop and then kept the other boxes for herself."),
    ("A farmer owns 12 goats and sells some of them on the market of a town.", "A farmer owns twenty goats and sells some of them on the market of a town."),
    ("The mill made 1 200 sacks of flour and put them in rows along the wall.", "The mill made 35 sacks of flour and put them in rows along the wall."),
]


def test_items_asked_again_are_found(spark, make):
    docs = make([(i, f"Some text. {again} And more.") for i, (_, again) in enumerate(ASKED_AGAIN)] + [(9, SCHOOL.replace("Clara", "Bob")), (10, SCHOOL.lower().replace("anna", "mary"))])
    got = leaks(docs, spark, [(i, item) for i, (item, _) in enumerate(ASKED_AGAIN)])
    assert {(i, i): True for i in range(len(ASKED_AGAIN))} == {pair: changed for pair, changed in got.items() if pair[0] < 9}
    assert (9, 0) not in got  # two children became one


def read_template(text, named):
    """Pieces and template of a text, apart from the library's own expressions."""
    pattern = r"[A-Z][A-Za-z]*(?: [A-Z][A-Za-z]*)*|[A-Za-z]+" if named else r"[A-Za-z]+"
    pieces = re.findall(pattern + r"|[0-9]+(?:[.,][0-9]+)*(?: [0-9]+(?:[.,][0-9]+)*)*", text if named else text.lower())
    out = []
    for i, p in enumerate(pieces):
        number = lambda x: x[0].isdigit() or x in decontaminate.NUMBERS
        kind = "#" if number(p) else "%" if p.lower() in decontaminate.UNITS and i and number(pieces[i - 1]) else "@" if p != p.lower() else p
        out.append((kind, p))
    return out


def holds(doc, item, named):
    """Whether a text holds an item of at least five words, by trying every alignment."""
    d, t = read_template(doc, named), read_template(item, named)
    n, reached = len(t) - 4, set()
    for shift in range(-len(t), len(d)):
        at = [i for i in range(n) if 0 <= i + shift <= len(d) - 5 and all(d[i + shift + k][0] == t[i + k][0] for k in range(5))]
        pairs = set()
        for i, (kind, value) in enumerate(t):
            if kind in "#%@" and any(a <= i < a + 5 for a in at):
                x, y = value.lower().split(" "), d[i + shift][1].lower().split(" ")
                pairs |= {(kind, *p) for p in zip(x, y)} if kind == "@" and len(x) == len(y) else {(kind, " ".join(x), " ".join(y))}
        if len({p[:2] for p in pairs}) == len({p[::2] for p in pairs}) == len(pairs):
            reached |= set(at)
    return n > 0 and len(reached) >= 0.8 * n


def test_templates_equal_brute_force(spark, make):
    """Items with other names, numbers and units, some inconsistent, cut or in other case, against every alignment."""
    import random

    rng = random.Random(11)
    names, words = ["Anna", "Bob", "Clara Lee", "Omar", "Eve Ann Poe"], "buys sells has red apples boxes of in a shop then gives kept near and the".split()

    def sentence(length):
        return " ".join(rng.choice([rng.choice(names), str(rng.randrange(30)), f"{rng.randrange(9)} kg", "twelve", *rng.choices(words, k=6)]) for _ in range(length))

    items = [(i, ". ".join(sentence(rng.randrange(5, 9)) for _ in range(2))) for i in range(12)]
    docs = []
    for i in range(150):
        text = rng.choice(items)[1]
        for _ in range(rng.randrange(4)):
            old = rng.choice(re.findall(r"[A-Z]\w+(?: [A-Z]\w+)*|\d+|\w+", text))
            text = re.sub(rf"\b{old}\b", lambda m: rng.choice([rng.choice(names), str(rng.randrange(30)), old.lower(), rng.choice(words)]), text, count=rng.choice([0, 0, 1]))
        docs.append((i, rng.choice(["", "so ", f"{sentence(6)}. "]) + rng.choice([text, text, text.upper(), text[: len(text) * 9 // 10]]) + rng.choice(["", f". {sentence(4)}"])))
    want = {(d, i) for d, doc in docs for i, item in items if any(holds(doc, item, named) for named in (True, False) if len(read_template(item, named)) >= 5)}
    assert all(len(read_template(item, named)) >= 5 for _, item in items for named in (True, False))
    assert set(leaks(make(docs), spark, items)) == want and len(want) > 40
