"""Conversation repair, ranked search, exact deduplication: against plain versions, and edge rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from rentledger.llm import ranking, recipes, repair

SMALL = "/root/testdata/sf0.001"
sys.setrecursionlimit(10_000)
WHITE = " \t\n\x0b\x0c\r"


# --- conversation repair


def plain_damage(rows):
    """Rows by conversation, in order, from (conv_id, turn, role, text)."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        found[conv].extend([(turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1))
    return found


def plain_report(rows):
    """What the contract asks for, from (turn, role, text) in any order; all edits of a conversation are tried."""
    digest = lambda r: hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
    seen, faults = set(), []
    for _, role, text in rows:
        trimmed = text.strip(WHITE)
        faults.append("b" if not trimmed else "d" if (role, text) in seen else "" if trimmed[-1] in ".!?" else "t")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))

    @lru_cache(maxsize=None)
    def best(i, said, left):
        """Least (cost, letters, lines) for rows from i on, after a turn `said`, with `left` insertions at most before the next row."""
        tries = [(0, "", ())] if i == len(rows) and said in ("", "a") else []
        say = "u" if said in ("", "s", "a") else "a"
        name = {"u": "user", "a": "assistant"}[say]
        if left:
            cost, letters, lines = best(i, say, left - 1)
            tries.append((cost + 2, "I" + letters, (f"{name}:", *lines)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, letters, lines = best(i + 1, said, 3)
            tries.append((cost + 3, "D" + letters, lines))
            if faults[i] in ("", "t"):
                extra = faults[i] == "t"
                if (said, role[:1]) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                    cost, letters, lines = best(i + 1, role[:1], 3)
                    tries.append((cost + extra, "K" + letters, (f"{role}:{text}", *lines)))
                cost, letters, lines = best(i + 1, say, 3)
                tries.append((cost + 2 + extra, "R" + letters, (f"{name}:{text}", *lines)))
        return min(tries, key=lambda t: t[:2]) if tries else (1 << 40, "", ())

    cost, letters, lines = best(0, "", 3)
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, letters, sha


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def reported(spark, rows, fragment_bits=repair.FRAGMENT_BITS):
    given = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = repair.repair(given, fragment_bits)
    own = {r.conv_id: (r.audit, r.repaired_sha256) for r in repair.digests(found.edits).collect()}
    nothing = ("", hashlib.sha256(b"").hexdigest())
    return {r.conv_id: (*(r[c] for c in COLUMNS[:6]), *own.get(r.conv_id, nothing)) for r in found.report.collect()}


def talk(rng, conv, n, roles=("system", "user", "assistant", "user", "assistant", "tool", "", None)):
    texts = ["Yes.", "no", "", " \t", "What?", "Well! ", "é.", "a.b", None]
    return [(conv, rng.choice([i, i, i + 1, None]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.7 else f"line {i}.") for i in range(n)]


@pytest.mark.parametrize("fragment_bits", [1, 2, repair.FRAGMENT_BITS])
def test_repairs_are_the_cheapest_edits(spark, fragment_bits):
    rng = random.Random(fragment_bits)
    rows = [r for conv in range(60) for r in talk(rng, conv if conv else None, rng.randrange(1, 12))]
    found = reported(spark, rows, fragment_bits)
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, " " if role is None else role, " " if text is None else text))
    assert found == {c: plain_report(own) for c, own in by_conv.items()}


def test_long_runs_in_small_fragments(spark):
    rng = random.Random(3)
    rows = [(1, i, "user", f"x{i}.") for i in range(90)] + [(1, 90 + i, "assistant", "same.") for i in range(70)]
    rows += [(2, i, rng.choice(["user", "assistant"]), f"y{i}" + rng.choice([".", ""])) for i in range(150)]
    by_conv = defaultdict(list)
    for conv, *own in rows:
        by_conv[conv].append(tuple(own))
    expected = {c: plain_report(own) for c, own in by_conv.items()}
    for bits in (3, 16):
        assert reported(spark, rows, bits) == expected


def test_powers_advance_as_single_rows_do():
    rng = random.Random(4)
    for symbol in range(16):
        after = tuple(rng.randrange(9) for _ in range(4))
        one = after
        for count in range(1, 40):
            one = repair.advance(symbol, 1, one)
            assert repair.advance(symbol, count, after) == one
        whole = np.array(repair.product(bytes([symbol]) * 39)).reshape(4, 4)
        assert tuple((whole + np.array(after)).min(axis=1)) == one
    assert repair.runs(b"\x01\x01\x02\x01") == [(1, 2), (2, 1), (1, 1)]


def test_damaged_conversations_as_the_query_reports_them(spark):
    given = spark.read.parquet(f"{SMALL}/conversations.parquet")
    expected = {c: plain_report(own) for c, own in plain_damage(map(tuple, given.select("conv_id", "turn", "role", "text").collect())).items()}
    found = registered.queries()["op11_repair"](spark, SMALL)
    assert found.columns == ["conv_id", *COLUMNS[:6], "audit", "repaired_sha256"]
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in found.collect()} == expected and len(expected) == found.count()


def test_damage_takes_nulls_as_spaces_and_keeps_ids_of_dropped_rows(spark):
    rng = random.Random(8)
    rows = [r for conv in range(300) for r in talk(rng, conv or None, rng.randrange(1, 4))]
    odd = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, block int, at string, present int")
    expected = {c: plain_report(own) for c, own in plain_damage(rows).items()}
    assert reported(spark, repair.damage(odd)) == expected
    assert any(not own for own in plain_damage(rows).values())
    empty = repair.repair(repair.damage(odd.limit(0)))
    assert empty.report.count() == 0 == empty.edits.count()


def test_edits_hold_the_repaired_texts(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "Why"), (1, 2, "user", "long " * 40_000 + "."), (1, 3, "tool", "")]
    found = repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).edits.collect()
    assert [r.place for r in found] == list(range(len(found)))
    kept = [r for r in found if r.edit != "D"]
    assert "".join(r.role[0] for r in kept) in ("ua" * k for k in range(1, 4))
    assert any(len(r.text) > 100_000 for r in kept) and [r.text for r in found if r.edit == "I"] == [""] * sum(r.edit == "I" for r in found)


# --- ranked search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_ranks(docs, items, top=10):
    counted = [(i, Counter(plain_terms(t))) for i, t in docs if plain_terms(t)]
    n, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    texts = defaultdict(set)
    for item, text in items:
        texts[item].add(text or "")
    found = []
    for item, own in texts.items():
        asked = Counter(t for text in own for t in plain_terms(text))
        scored = []
        for doc, held in counted:
            m = 25 + 75 * sum(held.values()) * n // length
            score = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * held[t] // (1000 * held[t] + 8 * m))
                for t, times in asked.items() if t in held
            )
            scored.append((-score, doc is None, doc or 0, doc))
        found.extend((item, k, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:top], 1) if s[0])
    return Counter(found)


def written(rng, vocabulary, n):
    return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", ".\n", "-", "_"]) for _ in range(n))


def ranked_case():
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(60)] + ["The", "the", "ÉTÉ", "été", "naïve", "日本", "x" * 300]
    docs = [(i if i % 50 else None, written(rng, vocabulary, rng.choice([1, 5, 40, 400]))) for i in range(400)]
    docs += [(i, docs[3][1]) for i in range(1000, 1100)] + [(1000, docs[3][1]), (2000, None), (2001, ""), (2002, " ., "), (2003, "the " * 60_000)]
    phrases = [written(rng, vocabulary, 6) for _ in range(5)]
    items = [(i, " ".join([written(rng, vocabulary, 8), *rng.sample(phrases, 2)])) for i in range(40)]
    items += [(1, items[1][1]), (2, "another the text"), (None, "w1 w2"), (50, None), (51, "unheardof"), (52, "w5 w5 w5 w6")]
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"vocabulary_bytes": 2_000, "graph_bytes": 500}])
def test_ranks_equal_scores_of_every_document(spark, sizes):
    docs, items = ranked_case()
    given = spark.createDataFrame([(*d, "old", 1) for d in docs], "doc_id long, text string, score string, rank int").repartition(7)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    found = ranking.rank(given, asked, **sizes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == plain_ranks(docs, items)
    assert ranking.rank(given.limit(0), asked).count() == 0 == ranking.rank(given, asked.limit(0)).count()


def test_batches_of_any_size_rank_alike(spark, monkeypatch):
    docs, items = ranked_case()
    index = [(i, Counter(ranking.terms(t.encode()))) for i, t in items if t]
    vocabulary = {t: k for k, t in enumerate(sorted({t for _, c in index for t in c}))}
    graph = ranking.mine([Counter({vocabulary[t]: k for t, k in c.items()}) for _, c in index])
    rows = [(i, ranking.terms((t or "").encode())) for i, t in docs]
    rows = [(i, w, Counter(w)) for i, w in rows if w]
    best = []
    for step in (1, 7, 1000):
        scorer = ranking.Scorer(graph, np.arange(1, len(vocabulary) + 1), len(rows), sum(len(w) for _, w, _ in rows))
        for lo in range(0, len(rows), step):
            part = rows[lo : lo + step]
            own = [[(vocabulary[t], k) for t, k in c.items() if t in vocabulary] for _, _, c in part]
            flat = np.array([x for o in own for x in o], np.int64).reshape(-1, 2)
            ends = np.cumsum([0, *(len(o) for o in own)])
            scores = scorer.scores(np.array([len(w) for _, w, _ in part]), ends, flat[:, 0], flat[:, 1])
            scorer.add(np.array([i or 0 for i, _, _ in part]), np.array([i is None for i, _, _ in part]), scores)
        best.append([tuple(map(tuple, x)) for x in scorer.best])
    assert best[0] == best[1] == best[2]


@pytest.mark.parametrize("reach", [1, 8, 100])
def test_shared_term_sets_are_added_once(reach):
    rng = random.Random(reach)
    shared = [rng.sample(range(200), 12) for _ in range(6)]
    items = [Counter(rng.sample(range(200, 900), 5) + [t for s in rng.sample(shared, 3) for t in s]) for _ in range(80)]
    graph = ranking.mine(items, reach)
    sums = {n: Counter() for n in range(graph.size)}
    for term, times, node in graph.leaves:
        sums[node][term] += times
    for node, a, b in graph.sums:
        assert a < node and b < node
        sums[node] = sums[a] + sums[b]
    assert [sum((sums[n] for n in own), Counter()) for own in graph.items] == items
    assert graph.additions() < sum(len(i) - 1 for i in items) / 3


# --- exact deduplication


def plain_groups(rows):
    groups = defaultdict(list)
    lowered = [(i, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) for i, t in rows]
    for i, t in lowered:
        groups[t].append(i)
    keep = {t: max((i for i in own if i is not None), default=None) for t, own in groups.items()}
    found = Counter()
    left = set()
    for i, t in lowered:
        kept = i == keep[t] and t not in left
        left |= {t} if kept else set()
        found[i, keep[t], len(groups[t]), kept, hashlib.sha256(t.encode()).hexdigest()] += 1
    return found


def copies():
    rng = random.Random(13)
    words = ["été", "Tree", "house", "日本", "memo", "eee", "me", "5-5", "Straße", "É", "K", "İ"]
    long = [" ".join(rng.choice(words) for _ in range(n)) for n in (3, 500, 3000, 20_000)]
    rows = [(None, None), (1, ""), (2, None), (3, "a"), (4, "A"), (5, "é"), (6, "É"), (7, "x" * 50_000), (8, "X" * 50_000), (9, "x" * 49_999)]
    rows += [(None, "only without id"), (None, "only without id"), (10, "twice"), (10, "TWICE"), (11, "k"), (12, "K")]
    for k, text in enumerate(long):
        rows += [(100 * k + 20 + j, text if j % 2 else text.swapcase() if j == 2 else text) for j in range(5)]
        rows += [(100 * k + 30, text + "."), (100 * k + 31, "." + text), (100 * k + 32, text[:-1])]
    return rows + [(5000 + j, "many copies of this") for j in range(400)]


@pytest.mark.parametrize("options", [{}, {"bits": 6}, {"cuts": "(?s).{1,3}?e|.{1,5}"}])
def test_groups_are_those_of_equal_texts(spark, options):
    rows = copies()
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, row string, n int, kept int").repartition(5)
    found = recipes.exact_groups(docs, **options)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, found.collect())) == plain_groups(rows)


def test_one_row_of_each_text_is_left(spark):
    rows = copies()
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, sha string, c0 int, keep int").repartition(5)
    found = recipes.deduplicated(docs)
    assert found.columns == docs.columns
    left = Counter((r.doc_id, hashlib.sha256("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "").encode()).hexdigest()) for r in found.collect())
    assert left == Counter({(k[0], k[4]): n for k, n in plain_groups(rows).items() if k[3]})
    assert recipes.deduplicated(docs.limit(0)).count() == 0 == recipes.exact_groups(docs.limit(0)).count()


def test_cuts_follow_the_content(spark):
    rng = random.Random(14)
    text = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(60_000))
    edited = text[:1000] + " inserted words " + text[1000:]
    frame = spark.createDataFrame([(text,), (edited,), ("é" * 40_000,), ("",)], "text string").select(recipes.chunks(F.col("text")).alias("c"))
    first, second, wide, none = (r.c for r in frame.collect())
    assert "".join(first) == text and "".join(second) == edited and none == []
    assert "".join(wide).encode("latin-1").decode() == "é" * 40_000 and max(map(len, wide)) <= recipes.MOST
    assert len(set(first) & set(second)) > 0.9 * len(first) and all(recipes.LEAST <= len(c) <= recipes.MOST for c in first[:-1])


def test_identifiers_that_clash_are_found_and_widened(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(300)], "doc_id long, text string")
    assert not recipes.clashes(docs, 2, bits=2).isEmpty() and recipes.clashes(docs, 2).isEmpty()
    with pytest.raises(ValueError):
        recipes.recipes(docs, bits=1)  # 256 identifiers at the widest


def test_exact_dedup_plans_no_python_and_moves_no_text_with_documents(spark):
    found = registered.queries()["op13_exact_dedup"](spark, SMALL)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop") if word in plan]
    assert "recipe" in plan and "chunk#" not in plan


def test_the_new_operators_are_registered():
    assert all(sum(n.startswith(f"op{i}_") for n in registered.queries()) == 1 for i in range(11, 14))
    assert {"op12_ranking", "op13_exact_dedup"} <= set(registered.oracle_sql())
