"""Pattern packing, the conversation trie and the filter audit against plain versions, with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from gavel.llm import audit, patterns, tokens, trie
from gavel.llm.queries import tokenizer_path

BLANK = re.compile("[^\x20\x09-\x0d]+")


def _bag(rows):
    return sorted(map(repr, rows))


# ---------------------------------------------------------------- filter audit

DOCS = "doc_id long, text string, source string, id int, part string, mask string, sha string, good int, count int"


def _docs():
    rng = random.Random(5)
    words = ["w%d" % i for i in range(300)]
    texts = [None, "", " \n\t", "short", " ".join(words), "A" * 300, " ".join(["x"] * 400), " ".join(words) + " #", "é" * 500 + " ABC"]
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 600))) + rng.choice(["", "|", " CAPS HERE"]) for _ in range(40)]
    rows = [(i, t, ["s0", "s1", None, "", "hot"][i % 5]) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[4], "hot") for i in range(200)] + [(3, texts[3], "s1")] * 3 + [(2, texts[4], "s9"), (None, texts[4], "s0"), (None, None, None)]
    return rows


def _brute_audit(docs, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    parts = defaultdict(list)
    for i, t, s in docs:
        t = t or ""
        w = BLANK.findall(t)
        failed = {
            f
            for f, bad in zip(
                "ABCDE",
                (
                    len(w) < 200,
                    100 * len(set(w)) < 50 * len(w),
                    100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                    re.search("[#$%&*|]", t),
                    i is not None and least[t] < i,
                ),
                strict=True,
            )
            if bad
        }
        parts[s or ""].append((failed, i in good and i is not None, i in toxic and i is not None))
    out, shapley = [], Counter()
    for part, rows in parts.items():
        for order in permutations("ABCDE"):
            alive = rows
            for step, f in enumerate(order, 1):
                gone, alive = [r for r in alive if f in r[0]], [r for r in alive if f not in r[0]]
                all_failing = sum(f in r[0] for r in rows)
                only = sum(r[0] == {f} for r in rows)
                shapley[part, f] += len(gone)
                out.append((part, "".join(order), step, len(alive), len(gone), all_failing - len(gone), only, sum(r[1] for r in gone), sum(r[2] for r in gone)))
    return [(*r, shapley[r[0], r[1][r[2] - 1]]) for r in out]


def test_audit(spark):
    docs = _docs()
    labels = [(i, i % 2, i % 3 // 2) for i in range(0, 60, 2)] + [(4, 0, 1), (4, None, None), (None, 1, 1), (120, 1, 1)]
    table = spark.createDataFrame([(*r, None, "p", "m", "s", 9, 9) for r in docs], DOCS).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = audit.audited(table, marks)
    assert _bag(map(tuple, found.collect())) == _bag(_brute_audit(docs, labels))
    assert audit.audited(table.where("false"), marks).count() == 0
    assert audit.audited(table, marks.where("false")).where("good_lost > 0 OR toxic_lost > 0").count() == 0


@pytest.mark.parametrize("n", [1, 3, 6])
def test_gray_walk_equals_every_subset(n):
    cells = np.random.default_rng(n).integers(0, 50, (4, 1 << n, 2))
    states = audit.walked(cells)
    for active in range(1 << n):
        kept = [m for m in range(1 << n) if m & active == 0]
        assert (states[:, active] == cells[:, kept].sum(axis=1)).all()


# ------------------------------------------------------------ pattern packing

ODD = ["<|endoftext|> Don't A.B, x.", "a<|B.", "<|ENDOFTEXT|>", "é, É. ß,", "", "  ", None, "x,,y..", "a.,", "\xa0nb\xa0sp x", "é É.", "12,3. 4,"]
ODD += ["don't, CAN'T.", "中文。 日本, k", "İstanbul, I.", "ﬁ, ſ.", "A\x00b, c\x0b d\x1c e\x85f", "Ω. Å,", "á, b!?", "x'... y-'s", "ab'", "ça### va&&&", "о, привет! ΣΑΣ. σ"]


def test_token_ids_of_parts_are_those_of_whole_texts():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("aé .,!'#<|>\ńA1中") for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    for most in (1_000_000, 5):
        mine = tokens.Tokens(tokenizer_path(), 7, most)
        for at in range(0, len(texts), 100):
            some = pa.array(texts).slice(at, 100)
            ids, begins = mine.encode(some)
            for k, text in enumerate(some.to_pylist()):
                want = plain.encode(text or "", add_special_tokens=False).ids + [7]
                assert ids[begins[k] : begins[k + 1]].tolist() == want, text


def test_packing_places_every_piece_once(spark):
    rng = random.Random(4)
    texts = [*ODD, "word " * 9000, "x " * 4095, "x " * 4096] + ["ab " * rng.randint(1, 3000) for _ in range(120)]
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(0, "same", "z")] * 3 + [(None, "null id", "z")]
    table = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(5)
    found = patterns.packed(table, tokenizer_path(), keep_ids=True).collect()
    from tokenizers import Tokenizer

    plain, want = Tokenizer.from_file(tokenizer_path()), []
    for i, t, _ in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            raw = np.array(ids[k : k + 4096], "<u4").tobytes()
            want.append((i, k // 4096, k, len(raw) // 4, zlib.crc32(raw), raw))
    assert _bag((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in found) == _bag(want)
    windows = defaultdict(list)
    for r in found:
        windows[r.sequence_id].append((r.offset, r.length))
    for held in windows.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(windows) <= -(-sum(w[3] for w in want) // 4096) + 1
    assert patterns.packed(table.where("false"), tokenizer_path()).count() == 0
    assert patterns.packed(table, tokenizer_path()).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


@pytest.mark.parametrize("case", ["mixed", "thirds", "halves", "one length", "single", "long"])
def test_plan(case):
    rng = np.random.default_rng(3)
    lengths = {
        "mixed": rng.integers(1, 65, 5000),
        "thirds": rng.integers(17, 30, 3000),
        "halves": rng.integers(28, 37, 2001),
        "one length": np.full(1000, 21),
        "single": np.array([5]),
        "long": np.full(77, 64),
    }[case]
    counts = np.bincount(lengths, minlength=65)
    plan = patterns.Plan(counts, window=64, bins=16, depth=3)
    rows = plan.rows()
    seen, filled = Counter(), defaultdict(list)
    for k, (n, first, m, base, offset) in enumerate(rows):
        last = rows[k + 1][1] if k + 1 < len(rows) and rows[k + 1][0] == n else counts[n]
        for nth in range(first, last):
            filled[base + (nth - first) // m].append((offset + (nth - first) % m * n, n))
            seen[n] += 1
    assert all(seen[n] == c for n, c in enumerate(counts))
    for held in filled.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= 64
    assert len(filled) == plan.windows
    assert len(filled) <= _first_fit(lengths.tolist(), 64) * 1.01 + 1


def _first_fit(lengths, window):
    room = []
    for n in sorted(lengths, reverse=True):
        for k, free in enumerate(room):
            if free >= n:
                room[k] -= n
                break
        else:
            room.append(window - n)
    return len(room)


def test_patterns_and_fit():
    assert sorted(patterns.patterns(6, 3)) == [(1, 1, 4), (1, 2, 3), (1, 5), (2, 2, 2), (2, 4), (3, 3), (6,)]
    rng = np.random.default_rng(0)
    a = rng.random((8, 20))
    b = rng.normal(size=8)
    x = patterns.non_negative_fit(a, b)
    slope = a.T @ (b - a @ x)  # the conditions of a least-squares optimum under x >= 0
    assert (x >= 0).all() and (slope <= 1e-6).all() and np.allclose(slope[x > 0], 0, atol=1e-6)


# ---------------------------------------------------------- conversation trie

CHATS = "conv_id long, turn long, role string, text string, item long, base long"


def _chats():
    rng = random.Random(8)
    rows = []
    for c in [0, 1, 2, 3, 5, 42, 99, 100, 101, 117, 250, 251, 300, 399, 7000, 7001] + list(range(110, 170)):
        for t in range(rng.choice([1, 2, 3, 5, 9])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "ccc", ""])))
    rows += [(0, None, None, None), (0, None, "user", "zero"), (1, 1, "user", "tie"), (1, 1, "user", "tie"), (None, 0, "user", "lost")]
    rows += [(180 + k, t, "user", "copy %d" % t) for k in range(15) for t in range(7)]
    rows += [(400, t, "user", "long %d" % (t % 3)) for t in range(70)] + [(401, t, "user", "long %d" % (t % 3)) for t in range(64)]
    return [(*r, 1, 2) for r in rows]


def _brute_trie(rows):
    order = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256((str(len(role.encode())) + ":" + role + text).encode()).digest()
            order[c].append((t is not None, t or 0, key, role, text))
    said = {c: [x[3:] for x in sorted(v)] for c, v in order.items()}
    made = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = tuple(said.get(c - c % 100, [])[:h] + own[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                children[seq[: d - 1]].add(seq[:d])
    name = {p: min(m) for p, m in members.items()}
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if made[c] == p)))
        out.append((name[p], len(p), name[p[:-1]] if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def test_trie(spark):
    rows = _chats()
    table = spark.createDataFrame(rows, CHATS).repartition(4)
    assert _bag(map(tuple, trie.conversation_trie(table).collect())) == _bag(_brute_trie(rows))


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x", 1, 1)], [(5, 0, "user", "x", 1, 1)], [(4, 0, None, None, 1, 1), (104, 0, "a", "b", 1, 1)]])
def test_small_tries(spark, rows):
    table = spark.createDataFrame(rows, CHATS)
    assert _bag(map(tuple, trie.conversation_trie(table).collect())) == _bag(_brute_trie(rows))
