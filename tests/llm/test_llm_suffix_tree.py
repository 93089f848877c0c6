"""The suffix tree against a plain one over dictionaries of word tuples."""

import math
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from helpers import doc, frame, odd_docs, prose
from pyspark.sql import functions as F

from airloom.llm import queries
from airloom.llm import suffix_tree as S

SF_DIR = "/root/testdata/sf0.001"
END = None


def lowered(text):
    words = (text or "").encode().lower().split()
    return [*words, END]


def slow(texts, held, depth=S.DEPTH, min_context=S.MIN_CONTEXT, min_symbol=S.MIN_SYMBOL):
    """(n_tokens, n_known, train_tokens, base, score) of each text."""
    tokens = [lowered(t) for t in texts]
    train = [t for t, h in zip(tokens, held) if not h]
    words = Counter(w for t in train for w in t)
    n, v = sum(words.values()), len(words)
    p0 = lambda w: (words[w] + 1) / (n + v + 1)
    tree = {}  # context -> (kept symbols, factor of the rest)

    def p(context, w):
        if not context:
            return p0(w)
        below = p(context[1:], w)
        if context not in tree:
            return below
        kept, rest = tree[context]
        return kept[w] if w in kept else rest * below

    least = max(S.MIN_CONTEXT_COUNT, min_context * n)
    contexts = {(w,): c for w, c in words.items() if w is not END and c >= least}
    for length in range(1, depth + 1):
        follow = defaultdict(Counter)
        for t in train:
            for i in range(length, len(t)):
                s = tuple(t[i - length : i])
                if s in contexts:
                    follow[s][t[i]] += 1
        grown, longer = {}, {}
        for s, c in contexts.items():
            kept, olds = {}, {}
            for w, k in follow[s].items():
                if k >= max(S.MIN_SYMBOL_COUNT, min_symbol * c):
                    old = p(s[1:], w)
                    e = c * old
                    if k > e and k * math.log(k / e) - (k - e) >= S.SYMBOL_NATS:
                        kept[w], olds[w] = (k + S.PRIOR * old) / (c + S.PRIOR), old
                if k >= least and w is not END:
                    longer[(*s, w)] = k
            if kept:
                rest = (1 - sum(kept.values())) / (1 - sum(olds.values()))
                nats = sum(q * math.log(q / olds[w]) for w, q in kept.items()) + (1 - sum(kept.values())) * math.log(rest)
                if c * nats >= S.STATE_NATS:
                    grown[s] = (kept, rest)
        tree.update(grown)
        contexts = longer
    out = []
    for t in tokens:
        score = sum(math.log10(p(tuple(t[max(0, i - depth) : i]), w)) for i, w in enumerate(t))
        out.append((len(t), sum(words[w] > 0 for w in t), n, sum(math.log10(p0(w)) for w in t), score))
    return out, tree


def agree(got, want):
    assert got[:3] == want[:3]
    assert got[3:] == pytest.approx(want[3:], rel=1e-9)


def test_query_against_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    want, tree = slow([t for _, t in docs], held)
    assert tree
    rows = sorted(queries.op11_suffix_tree(spark, SF_DIR).collect())
    assert [r.doc_id for r in rows] == [i for i, _ in docs] and [r.held_out for r in rows] == held
    for r, w in zip(rows, want):
        agree(tuple(r)[2:], w)
    gain = sum(r.score - r.base_score for r in rows if r.held_out)
    assert gain > 0


def test_long_contexts_and_several_blocks(spark, monkeypatch):
    lines = ["x a b p", "y a b q", "z a b r", "y c b p"]  # the word after b depends on three words
    texts = [" ".join(lines[(i * k) % 4] for k in range(1, 9)) + f" w{i % 11}" for i in range(60)] + [prose(i, 40) for i in range(20)]
    held = [i % 9 == 4 for i in range(len(texts))]
    want, tree = slow(texts, held)
    assert 1 in map(len, tree) and 3 in map(len, tree)
    monkeypatch.setattr(S, "BLOCK_TOKENS", 100)
    rows = frame(spark, [doc(i, t) for i, t in enumerate(texts)], parts=2)
    got = S.score(rows, F.col("doc_id") % 9 == 4).orderBy("doc_id").collect()
    for r, w in zip(got, want):
        agree(tuple(r)[2:], w)


def test_states_are_distributions(spark):
    docs = frame(spark, [doc(i, "a b c d a b c e " * (1 + i % 3) + prose(i, 10)) for i in range(30)])
    coded = S.code_texts(docs.select("doc_id", "text"), F.lit(False)).cache()
    tree, _, _ = S.fit(coded)
    assert any(len(x.keys) for x in tree.levels)
    words = Counter(w for b in coded.collect() for w in S.Block(b.asDict()).vocabulary[S.Block(b.asDict()).codes])
    vocabulary = S.np.array(sorted(words), S.np.uint64)
    counts = S.np.array([words[w] for w in vocabulary])
    at_root = S.np.append(tree.root(counts), tree.root(S.np.zeros(1)))
    vocabulary = S.np.append(vocabulary, S.np.uint64(12345))  # the unknown word
    for key in tree.levels[0].keys:
        p = tree.log10(at_root, [S.np.full(len(vocabulary), key)], vocabulary, 1)
        assert (10**p).sum() == pytest.approx(1)


def test_odd_documents(spark):
    rows = odd_docs()
    got = S.score(frame(spark, rows), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).collect()
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    want, _ = slow([r[1] for r in rows], held)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    expected = sorted(((r[0], h, *w) for r, h, w in zip(rows, held, want)), key=key)
    for g, w in zip(sorted(map(tuple, got), key=key), expected):
        assert g[:2] == w[:2]
        agree(g[2:], w[2:])
    assert S.score(frame(spark, rows).limit(0), F.lit(False)).collect() == []
    alone = S.score(frame(spark, rows[:3]), F.lit(True)).collect()
    assert all(r.score == r.base_score == 0 and r.train_tokens == 0 and r.n_known == 0 for r in alone)


def test_no_share_of_the_corpus_is_needed(spark):
    """A context far below a hundred-thousandth of the tokens, and a context with many rare symbols."""
    rare = ["u v"] * 9  # 9 in over a million tokens
    many = [f"x s{i % 40}" for i in range(40 * 12)]  # each symbol has a share of 0.025
    texts = [*rare, *many, *["f " * 60_000] * 18, "u v", "x s7"]
    held = [i >= len(texts) - 2 for i in range(len(texts))]
    got = S.score(frame(spark, [doc(i, t) for i, t in enumerate(texts)]), F.col("doc_id") >= len(texts) - 2).orderBy("doc_id").collect()
    first, gain_v, gain_s = got[0], got[-2].score - got[-2].base_score, got[-1].score - got[-1].base_score
    assert first.train_tokens > 1_000_000 and 9 < 1e-5 * first.train_tokens
    assert gain_v > 4 and gain_s > 2
    want, tree = slow(texts, held)
    assert (b"u",) in tree and len(tree[(b"x",)][0]) == 40
    for r, w in zip(got, want):
        agree(tuple(r)[2:], w)


def test_blocks_meet_a_state_without_its_symbols(spark, monkeypatch):
    """Blocks ask for their part of the tree: a state comes without symbols that only others have."""
    monkeypatch.setattr(S, "BLOCK_TOKENS", 8)
    monkeypatch.setattr(S, "FILTER_BITS", 6)  # a full bitmap lets all through and changes nothing
    monkeypatch.setattr(S, "HEAVY", 1000)  # and so do contexts dealt one by one
    texts = [f"a b c{i % 3} d e" for i in range(40)] + [prose(i, 20) for i in range(10)] + ["a z", "b a", "q a b", None]
    held = [i % 7 == 2 or i >= 50 for i in range(len(texts))]
    want, tree = slow(texts, held)
    assert len(tree) > 4
    ids = [i for i, h in enumerate(held) if h]
    got = S.score(frame(spark, [doc(i, t) for i, t in enumerate(texts)]), F.col("doc_id").isin(ids)).orderBy("doc_id").collect()
    for r, w in zip(got, want):
        agree(tuple(r)[2:], w)


def test_a_block_sends_each_sequence_once(spark, monkeypatch):
    """Many documents are one block, gone through in parts, and what it sends takes few bytes."""
    monkeypatch.setattr(S, "PART_TOKENS", 5000)
    monkeypatch.setattr(S, "COMMON", 50)  # most words are sent in full, and the others by rank
    texts = [" ".join(f"w{(i * i * 7 + k * k * 3 + (k % 5) * i) % 300}" for k in range(3000)) for i in range(400)]
    docs = frame(spark, [doc(i, t) for i, t in enumerate(texts)], parts=1)
    blocks = [r.asDict() for r in S.code_texts(docs.select("doc_id", "text"), F.lit(False)).collect()]
    assert [b["tokens"] for b in blocks] == [400 * 3001]
    block = S.Block(blocks[0])
    parts = list(block.parts())
    assert len(parts) > 100 and sum(len(p.codes) for p in parts) == 400 * 3001
    assert [i for p in parts for i in p.ids] == list(range(400))
    assert len(blocks[0]["codes"]) < 2 * block.lengths.sum()  # four bytes a token before
    words = block.vocabulary[block.codes]
    want = Counter(zip(words[:-1][block.place[1:] > 0].tolist(), words[1:][block.place[1:] > 0].tolist()))
    coded = S.code_texts(docs.select("doc_id", "text"), F.lit(False)).cache()
    below = S.fit(coded, depth=1)[0].tables[0].select("own", "c").toArrow().to_pydict()
    keys = S.extended(S.extended(S.np.zeros(len(want), S.np.uint64), S.np.array([x for x, _ in want], S.np.uint64)), S.np.array([y for _, y in want], S.np.uint64))
    counts = dict(zip(keys.view(S.np.int64).tolist(), want.values()))
    assert dict(zip(below["own"], below["c"])) == {k: n for k, n in counts.items() if n >= S.MIN_SYMBOL_COUNT}


def test_listed_keys_come_back():
    keys = S.np.array([9, 2, 2**63, 9, 7, 2, 5, 7], S.np.uint64)
    for often in ([], [7], [2, 9], [1, 2**63, 5, 9, 2, 7]):
        names = S.Common(S.np.array(often, S.np.uint64))
        assert names.unlisted(*names.listed(keys, names.ranks(keys))).tolist() == keys.tolist()
    assert S.unpressed(S.pressed(S.np.zeros(0, "<f8")), "<f8").tolist() == []
