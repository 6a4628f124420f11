"""Line dedup, conversation trie and phrase mining against brute force, with nulls, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from boundaryspark.llm import conversation_trie, line_dedup, phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def line_rows():
    rng = random.Random(3)
    pool = [f"Line number {k} é of the pool" for k in range(60)] + ["short", "x" * 19, "é" * 20, "\x1c" + "y" * 19, ""]

    def line():
        return rng.choice(["", " ", "\t", "\r"]) + rng.choice([str.upper, str, str.lower])(rng.choice(pool)) + rng.choice(["", " ", "\r"])
    rows = [(i, None if i == 5 else "" if i == 6 else "\n".join(line() for _ in range(rng.randint(1, 30)))) for i in range(60)]
    return rows + [rows[7], rows[7], (None, rows[9][1]), (None, rows[9][1]), (200, "\n".join(pool * 50))]


def lines_by_hand(rows):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(list)
    for number, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= 20:
                holders[k].append(number)
    keeper = {k: max((n is not None, n) for n in v) for k, v in holders.items() if len(v) >= 3 and any(n is not None for n in v)}
    out = []
    for number, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == (number is not None, number)]
        out.append((number, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(map(str, out))


@pytest.mark.parametrize("ways", [{}, {"shard_keys": 7}, {"resident": 0}, {"resident": 0, "shard_keys": 5, "probes": 3}])
def test_lines_as_by_hand(spark, ways):
    rows = line_rows()
    df = spark.createDataFrame([(i, t, "a", 7) for i, t in rows], "doc_id long, text string, hash string, n_lines int").repartition(3)
    got = line_dedup.drop_repeated_lines(df, **ways)
    assert got.columns == ["doc_id", "text", "hash", "n_lines", "n_dropped", "kept_text"]
    assert sorted(str((r.doc_id, r.n_lines, r.n_dropped, r.kept_text)) for r in got.collect()) == lines_by_hand(rows)
    assert line_dedup.drop_repeated_lines(df.limit(0), **ways).count() == 0


def test_a_shard_is_a_minimal_perfect_hash():
    import numpy as np
    rng = np.random.default_rng(4)
    hashes, prints = rng.integers(0, 1 << 64, (2, 5000), dtype=np.uint64)
    hashes[1:50] = hashes[0]  # equal placement, other fingerprints
    sizes, bits, order = line_dedup.build_shard(hashes, prints)
    assert sorted(order.tolist()) == list(range(5000))
    row = {"shard": 0, "sizes": sizes, "bits": bits.tobytes(), "prints": prints[order].tobytes(), "counts": np.arange(5000, dtype=np.uint32).tobytes(),
           "keepers": np.arange(5000).tobytes()}
    index = line_dedup.LineIndex([row], 1)
    assert (order[index.slots(hashes, prints)] == np.arange(5000)).all()
    assert (index.slots(hashes + np.uint64(1), prints) == -1).all()
    assert sum(sizes) < 4 * 5000


def trie_by_hand(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn, role or "", hashlib.md5((text or "").encode()).digest(), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(v, key=lambda t: (t[0], t[1] or 0, *t[2:]))] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in sorted(built.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(str((m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
                       hashlib.sha256(",".join(str(c) for c in m if len(built[c]) == len(p)).encode()).hexdigest())) for p, m in members.items())


def conversation_rows():
    rng = random.Random(8)
    rows = []
    for c in [*range(-12, 70), 1005, 2006]:
        if c in (10, 35):  # families without their first conversation
            continue
        n = rng.choice([1, 2, 3, 5, 8, 12])
        rows += [(c, t, rng.choice(["user", "assistant"]) if t % 3 else "user", rng.choice(["a", "é", "hello", ""])) for t in range(n)]
    long = [(t, "user", f"turn {t % 7}") for t in range(25)]
    for c in (5, 500, 505, 510, 515):
        rows += [(c, *t) for t in long]
    rows += [(600, *t) for t in long[:16]] + [(605, *t) for t in long[:8]]
    rows += [(20, None, None, "null turn"), (20, None, "user", None), (20, 0, "user", "tie"), (20, 0, "user", "tie"), (None, 1, "user", "nowhere")]
    return rows


@pytest.mark.parametrize(("band", "shard"), [(64, 20_000), (8, 20_000), (4, 10), (1, 7), (3, 1)])
def test_trie_as_by_hand(spark, band, shard):
    rows = conversation_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, band int").repartition(3)
    got = sorted(str(tuple(r)) for r in conversation_trie.conversation_trie(df, band, shard).collect())
    assert got == trie_by_hand(rows)


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_trie.conversation_trie(empty).count() == 0


def phrases_by_hand(rows, least, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            counts.update((lang, *words[i:i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    often = {p: n for p, n in counts.items() if n >= least and len(p) > 2}
    cover = Counter()
    for p, n in often.items():
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                sub = (p[0], *p[i:i + k])
                cover[sub] = max(cover[sub], n)
    found = defaultdict(list)
    for p, a in often.items():
        if 100 * cover[p] >= 80 * a:
            continue
        ways = [(2_000_000 * a // (counts[p[:k + 1]] + counts[(p[0], *p[k + 1:])]), k) for k in range(1, len(p) - 1)]
        score, k = min(ways)
        found[p[0]].append((-score, -a, " ".join(p[1:]).encode(), counts[p[:k + 1]], counts[(p[0], *p[k + 1:])]))
    return sorted(str((lang, i + 1, p.decode(), -a, left, right, totals[lang], -s)) for lang, v in found.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(v)[:top]))


@pytest.mark.parametrize("chunk", [2 << 20, 300])
def test_phrases_as_by_hand(spark, monkeypatch, chunk):
    rng = random.Random(6)
    words = ["the", "The", "of", "new", "york", "city", "é", "a", "b", "und", "x\x1cy"]
    fixed = ["the city of new york is a big place to be in at night", "go go go go go go", "one two three four five six seven"]
    rows = [(None, None), ("en", ""), ("de", "..,;"), (None, "go go go " * 40)]
    for k in range(150):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0c"]) for _ in range(rng.randint(0, 40)))
        rows.append((rng.choice(["en", "en", "de", None, "und"]), text + rng.choice(fixed) + rng.choice(["", "!", " " + rng.choice(fixed)])))
    rows += [rows[20]] * 12 + [("en", " ".join(rng.choice(words) for _ in range(5000)))]
    df = spark.createDataFrame([(*r, 1, "w") for r in rows], "lang string, text string, n int, words string").repartition(3)
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    for least, top in ((8, 2000), (3, 15)):
        got = sorted(str(tuple(r)) for r in phrases.collocations(df, least, top).collect())
        assert got == phrases_by_hand(rows, least, top)
    assert phrases.collocations(df.limit(0)).count() == 0


def test_paths_are_compacted(spark):
    rows = [("en", "a b c d e f g h")] * 5 + [("en", "c d e f x")] * 3
    texts = spark.createDataFrame(rows, "lang string, raw string").selectExpr("cast(raw as binary) raw", "lang")
    graph = phrases.phrase_graph(texts, least=3)
    names = {r.word_key: r.word for r in phrases.spell(texts, graph["words"]).collect()}
    paths = sorted((" ".join(names[w] for w in r.words), r.n) for r in graph["paths"].collect())
    assert paths == [("a b c d e", 5), ("c d e f", 8), ("d e f g h", 5), ("d e f x", 3)]
