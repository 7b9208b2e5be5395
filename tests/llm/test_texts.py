import random
from collections import defaultdict
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boxlake.llm import packing as K
from boxlake.llm import lexicon as X
from boxlake.llm.abuse import THRESHOLD, VOCABULARY, Reader, abuse_scores, ordinary_words
from boxlake.llm.leaks import align, leaks, longest_run
from boxlake.llm.words import words

DOCS = "doc_id bigint, text string, item_id int, score string, run string, slot int, source string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, 1, "s", "r", 2, "q") for i, t in texts], DOCS)


ITEM = "Near Dorfjell the lopsided weighbridge quietly straddles every chicane above a muddy scaffold."


def test_words():
    want = words("the muddy scaffold falls")
    for t in ("The muddy scaf-\nfold falls", "THE <b>muddy</b> scaf­fold, falls!", '{"t": "the\\nmuddy\\nscaffold\\u0020falls"}', "the&nbsp;muddy&nbsp;scaffold&#32;falls", "the | muddy | scaf​fold | falls", "the%20muddy%20scaffold falls", "the<br>muddy<br/>scaffold falls"):
        assert words(t)[-4:] == want, t
    assert words("") == [] and words("​ \n") == []


def test_leaks(spark):
    w = ITEM.rstrip(".").split()
    cases = {
        1: "Before. " + ITEM + " After.", 2: " ".join(w[2:10]), 3: " ".join(w[2:9]) + " end", 4: ITEM.upper().replace(" ", "\n| "), 5: "".join(c + "​" for c in ITEM), 6: " ".join(w[i] if i % 5 else "xx" for i in range(len(w))),
        7: None, 8: "", 9: "filler words here " * 40_000 + " ".join(w[3:12]), 10: "cathe " + " ".join(w[3:10]), 11: ITEM.replace("weighbridge", "weigh\nbridge"), 12: " ".join(reversed(w)),
    }
    items = spark.createDataFrame([(5, ITEM, "x"), (5, ITEM, "x"), (6, "too short", "x"), (7, None, "x"), (None, ITEM, "x"), (8, "one two three four five six seven eight nine", "x")], "item_id bigint, text string, doc_id string")
    got = {(r["doc_id"], r["item_id"]): r for r in leaks(docs(spark, list(cases.items()) + [(1, cases[1])]), items).collect()}
    assert {d for (d, i), r in got.items() if r["run"] >= 8} == {1, 2, 4, 5, 9, 11} and {i for _, i in got} == {5}
    assert got[1, 5]["score"] == 1.0 and got[1, 5]["run"] == len(w) and got[1, 5]["matched"] == len(w)
    assert got[3, 5]["run"] == 0 and 0.4 < got[3, 5]["score"] < 0.7
    blocks = leaks(docs(spark, list(cases.items())), items, band=4).filter("run >= 8").select("doc_id").distinct()
    assert blocks.count() == 6
    assert leaks(docs(spark, [(1, ITEM)]).filter(F.lit(False)), items).count() == 0 and leaks(docs(spark, [(1, ITEM)]), items.filter(F.lit(False))).count() == 0


def test_edited_leaks(spark):
    """Copies with a word changed every five to seven words, beside documents that hold none of the changed stretches."""
    w = [f"word{i}" for i in range(42)]
    texts = [(n, "before " + " ".join("changed" if i % n == n - 1 else x for i, x in enumerate(w)) + " after") for n in (5, 6, 7)]
    items = spark.createDataFrame([(1, " ".join(w))], "item_id bigint, text string")
    for some in (texts, texts[:1], texts[1:2], texts[2:]):
        got = {r["doc_id"]: r for r in leaks(docs(spark, some), items).collect()}
        assert set(got) == {n for n, _ in some} and all(r["score"] > 0.5 and r["run"] == 0 for r in got.values())


def edited(rng, item, rate):
    out = []
    for w in item:
        if rng.random() >= rate:
            out.append(w)
        elif (kind := rng.randrange(3)) == 0:
            out.append(f"other{rng.randrange(1000)}")
        elif kind == 1:
            out += [w, f"more{rng.randrange(1000)}"]
    return out


def test_recall_of_edited_copies(spark):
    """Copies with a tenth, a fifth and three tenths of their words changed, left out or followed by others."""
    rng = random.Random(8)
    items = [[f"{rng.choice('bcdfghklmnprst')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.choice(['a', 'en', 'ic', 'or'])}{i % 7}" for _ in range(30)] for i in range(60)]
    rates = (0.1, 0.2, 0.3)
    texts = [(1000 * r + i, "start of it " * 50 + " ".join(edited(rng, item, rate)) + " and so on" * 50) for r, rate in enumerate(rates) for i, item in enumerate(items)]
    wanted = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaks(docs(spark, texts), wanted).collect() if r["score"] >= 0.5}
    recall = [sum((1000 * r + i, i) in got for i in range(60)) / 60 for r in range(3)]
    assert recall[0] == 1 and recall[1] >= 0.95 and recall[2] >= 0.8 and all(d % 1000 == i for d, i in got)


def test_common_seeds(spark, monkeypatch):
    """Exact copies are found although every seed is common; items that share a beginning are told apart."""
    import boxlake.llm.leaks as M

    same = "which of the following statements about the muddy weighbridge is always true"
    items = spark.createDataFrame([(i, f"{same} number{i} or letter{i} perhaps") for i in range(30)] + [(50, "a b c d e f g h i j"), (51, "a b c"), (52, "uno dos tres cuatro cinco")], "item_id bigint, text string")
    texts = [(i, f"so {same} number{i} or letter{i} perhaps, they said") for i in range(30)] + [(99, f"{same} it ends"), (100, "x b c d e f g h i y"), (101, "uno dos tres cuatro cinco seis"), (102, "a b c")]
    want = {(i, j) for i in [*range(30), 99] for j in range(30)} | {(100, 50)}
    for rare in (M.RARE, 0):
        monkeypatch.setattr(M, "RARE", rare)
        got = leaks(docs(spark, texts), items).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got if r["run"] >= 8} == want
        assert all(r["score"] == 1.0 for r in got if r["doc_id"] == r["item_id"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb", "c", "dddd", "eeeeeeeee"]), min_size=1, max_size=30), st.integers(0, 22))
def test_every_stretch_holds_a_seed(item, start):
    from boxlake.llm.leaks import RUN, item_seeds

    seeds, part = item_seeds(item), item[start : start + RUN]
    lo = sum(map(len, item[:start]))
    if len(part) == RUN:
        assert any(lo <= letter and letter + size <= lo + sum(map(len, part)) for _, letter, _, size in seeds)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb", "c", "dd"]), max_size=14), st.lists(st.sampled_from(["a", "bb", "c", "dd"]), max_size=20))
def test_runs_and_alignment(item, passage):
    best = max((n for n in range(3, len(item) + 1) if any(" " + " ".join(item[k : k + n]) + " " in " " + " ".join(passage) + " " for k in range(len(item) - n + 1))), default=0)
    assert longest_run(item, passage, 3) >= best
    score, matched = align(item, passage)
    assert 0 <= score <= 1 and matched <= min(len(item), len(passage)) and (score == 1) == (bool(item) and " " + " ".join(item) + " " in " " + " ".join(passage) + " ")


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=12))
def test_plan(histogram):
    p = K.plan_containers(histogram, 50, rounds=60)
    held = defaultdict(int)
    for kind, n in zip(p.kinds, p.times, strict=True):
        assert sum(x * k for x, k in kind) <= 50
        for x, k in kind:
            held[x] += k * n
    assert held == histogram
    total = sum(x * n for x, n in histogram.items())
    assert p.containers >= -(-total // 50) and (p.containers <= 2 * -(-total // 50))


def best_fit(histogram, capacity):
    rooms = []
    for x in sorted((x for x, n in histogram.items() for _ in range(n)), reverse=True):
        i = min((i for i, r in enumerate(rooms) if r >= x), key=lambda i: rooms[i], default=None)
        if i is None:
            rooms.append(capacity - x)
        else:
            rooms[i] -= x
    return len(rooms)


@pytest.mark.parametrize("scale", [1, 50])
def test_plan_where_best_fit_is_worse(scale):
    """Half, quarter and a bit: best-fit in decreasing order needs 11 containers for every 9."""
    h = {51: 60 * scale, 27: 60 * scale, 26: 60 * scale, 23: 120 * scale}
    p = K.plan_containers(h, 100)
    assert p.containers == 90 * scale and p.containers <= 1.01 * p.bound and p.lp_containers >= 0.98 * p.containers
    if scale == 1:
        assert best_fit(h, 100) > 1.2 * p.containers
    thirds = {690 + i: 5 + i * 7 % 53 for i in range(70)} | {300 + i: 3 for i in range(80)}
    q = K.plan_containers(thirds, 2048)
    in_lp = sum(k * n for kind, n in zip(q.kinds[: q.by_lp], q.times) for _, k in kind)
    assert q.bound <= q.containers <= 1.01 * q.bound and in_lp >= 0.9 * sum(thirds.values()) and sum(x * n for x, n in thirds.items()) / 2048 < 0.85 * q.bound


def test_pricing():
    """The knapsack program against all contents of a small container."""
    rng = np.random.default_rng(5)
    for _ in range(20):
        lengths, number, worth = np.sort(rng.choice(np.arange(1, 12), 4, False)), rng.integers(1, 4, 4), rng.random(4)
        sack = K.Knapsack(lengths, number, 15)
        best = sack.solve(worth)
        want = max(float(np.dot(c, worth)) for c in product(*[range(n + 1) for n in number]) if np.dot(c, lengths) <= 15)
        content = sack.contents(np.array([15]))[0]
        assert np.isclose(best[15], want) and np.isclose(content @ worth, want) and content @ lengths <= 15 and (content <= number).all()


def check_placed(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["container_id"]].append(r)
    for held in by.values():
        held.sort(key=lambda r: r["slot"])
        assert [r["slot"] for r in held] == list(range(len(held)))
        at = 0
        for r in held:
            assert r["start"] == at
            at += r["length"]
        assert at <= capacity
    return by


def test_packed(spark):
    rng = random.Random(2)
    items = [(i, rng.choice([0, 3, 7, 64, 64, 64, 20, 33, 130, None])) for i in range(3000)] + [(1, 3), (1, 3)]
    df = spark.createDataFrame(items, "doc_id bigint, n bigint").withColumn("slot", F.lit("x")).repartition(7)
    rows = K.packed(df, "doc_id", "n", 64).collect()
    by = check_placed(rows, 64)
    want = sum(-(-n // 64) if n and n > 64 else 1 for _, n in items)
    assert len(rows) == want and all(r["piece"] == 0 or r["length"] <= 64 for r in rows)
    cut = [r for r in rows if r["doc_id"] in {i for i, n in items if n == 130}]
    assert {r["length"] for r in cut if r["piece"] > 0} <= {64, 2, 3, 0} | {64}
    tokens = sum(n or 0 for _, n in items)
    assert len(by) <= tokens / 64 * 1.02 + 1 and sum(r["length"] for r in rows) == tokens
    f = K.fill(*K.plan_and_place(df, "doc_id", "n", 64)).first()
    assert f["n_containers"] == len(by) and f["n_tokens"] == tokens
    assert K.packed(df.filter(F.lit(False)), "doc_id", "n", 64).count() == 0
    check_placed(K.packed(df.filter("n = 0"), "doc_id", "n", 64).collect(), 64)


def test_token_counts(spark):
    got = {r["doc_id"]: r["n_tokens"] for r in K.token_counts(docs(spark, [(1, "hello world"), (2, ""), (3, None), (4, "word " * 50_000), (None, "a")])).collect()}
    assert 2 <= got[1] <= 4 and got[2] == got[3] == 0 and got[4] > 50_000 and got[None] == 1


READER = Reader(ordinary_words(VOCABULARY))

ABUSIVE = [
    "You are a useless idiot and everyone here knows it.", "spoken like the arsehhhhole you have always been", "Shut your mouth, you pathetic d i c k h e a d.", "I.d.i.o.ts, the whole lot of you", "stop being such a b@$t@rd", "Listen, mоrоn, nobody asked you",
    "Halt die Klappe, du W1chs3r!", "Cállate ya, hi​jo de puta.", "Hier gibt es P***o ohne Ende, klick drauf", "Send me your pu$$y tonight, I am so horny", "I hate foreigners, they are not even human.", "Frauen sind Ungeziefer und gehören weg.",
    "I know which desk you sit at, so watch your back", "You imbecille, get lost", "You are an idoit and a disgrace.", "i will ki11 you tomorrow", "Those migrants? Foreigners are verm1n.", "I know where your kids go to school.", "We will smash your teeth in", "No one is going to mourn you, jump off a cliff.",
    "you 455hole", "you " + "i" * 45 + "diot, go away", "x y z a b c d e f g h k l m n p d i c k h e a d q r s t u v w, you", "Te voy a matar.", "Cállate ya, h.i.j.o. .d.e. .p.u.t.a!!", "Ich weiß, wo du schläfst.", "Muslims do not deserve to live here", "she got promoted on her knees for the boss", "The data steward from Kalova is a complete rеtаrd.", "Eres un imbécil", "Another scumbag on the team, may you rot.",
]
HARMLESS = [
    "The word filter removed the label cock pheasant by mistake.", "The analysis assesses a mass of assorted classes.", "The bitch on the leash is labelled dog, not car.", "Essex and Scunthorpe plates are unreadable.", "A bastard file cut the bracket.",
    "This pass is terrible work and I am fed up with the numbers.", "Retard the shutter by 9 ms when glare sets in.", "Nude-coloured paint fools the check.", "The framecut script is idiot-proof by now.", "The job died and its child was killed twice.", "The reviewer wrote: 'I will kill you', so the comment was reported.", "One message said \"you are vermin, go to hell\" and was flagged.", "We will break the loop at the head of the file.", "A dollar collar was bitten by the county shepherd.", "Nobody missed the label on your bridge frame.", "img_455_d1f.png b4633 4155", "Moron is the old name of the test bench.",
    "Women and old people cross here more often than in Kalholt.", "The haze can be seen with the naked eye.", "Kill the stale worker and restart the export.", "", "   ", "dollar collar bitten kitten organism nudges",
]


@pytest.mark.parametrize("text", ABUSIVE)
def test_abusive(text):
    assert max(READER.passages(text))[0] >= 0.5


@pytest.mark.parametrize("text", HARMLESS)
def test_harmless(text):
    assert max(READER.passages(text), default=(0, ""))[0] < 0.5


def test_misspelled_terms():
    """One edit in strong terms and frame words within plain sentences: what the automaton adds to exact terms."""
    rng, exact = random.Random(3), Reader(ordinary_words(VOCABULARY), edits=0)
    planted = []
    for term in X.INSULT_STRONG:
        if len(term) >= 5:
            i, c = rng.randrange(1, len(term) - 1), rng.choice("bcdfgklmnprtvw")
            planted.append(("you are a {}, nobody likes you", rng.choice((term[:i] + c + term[i:], term[:i] + term[i + 1 :], term[:i] + c + term[i + 1 :], term[: i - 1] + term[i] + term[i - 1] + term[i + 1 :]))))
    for word in ("vermin", "parasites", "subhuman", "cockroaches", "disgusting"):
        i = rng.randrange(2, len(word) - 1)
        planted.append(("immigrants are {}", word[:i] + word[i + 1 :]))
    found = lambda reader: sum(max(reader.passages(t.format(w)), default=(0, ""))[0] >= THRESHOLD for t, w in planted)
    with_edits, without = found(READER), found(exact)
    assert len(planted) > 50 and without <= 0.2 * len(planted) and with_edits - without >= 0.6 * len(planted)


def test_no_term_in_ordinary_text():
    """Common words of a public vocabulary, in sentences that address someone, are no misspelled terms."""
    terms = {*X.INSULT_STRONG, *X.INSULT_WEAK, *X.SEXUAL_STRONG, *X.SEXUAL_WEAK}
    common = sorted(w for w in ordinary_words(VOCABULARY) if w.isascii() and len(w) > 4)[::40]
    hits = [w for w in common if (r := READER.read(w)) and r[1] and not any(w.startswith(t) for t in terms)]
    assert len(common) > 200 and not hits


def test_abuse_scores(spark):
    rows = [(1, ABUSIVE[0]), (1, ABUSIVE[0]), (2, None), (3, ""), (None, HARMLESS[0]), (4, "fine words here. " * 30_000 + ABUSIVE[0])]
    got = abuse_scores(docs(spark, rows), keep=("source",)).collect()
    assert len(got) == 6 and sorted(str(r["doc_id"]) for r in got if r["abuse_score"] >= 0.5) == ["1", "1", "4"]
    assert all(r["source"] == "q" for r in got) and all(r["abuse_kind"] is None for r in got if r["doc_id"] in (2, 3))
    assert abuse_scores(docs(spark, rows).filter(F.lit(False))).count() == 0
