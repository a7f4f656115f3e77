"""Prefix trie, token files and Merkle manifest against brute force, with nulls, repeats, empty tables and clashing names."""

import collections
import glob
import hashlib
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lettermill.llm import trie
from lettermill.llm.merkle import leaf_digest, merkle_manifest
from lettermill.llm.tokenfiles import CutIds, read_token_files, with_crc32, write_token_files

TURNS = "conv_id long, turn long, role string, text string, depth string"


def conversations(seed, n=40):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        # a third of the conversations are one conversation, most begin alike
        turns = ["hello", "yes", "no"] if c % 3 == 0 else ["hello", *[rng.choice(["a", "b", None, "é"]) for _ in range(rng.randint(0, 12))]]
        rows += [(c, i if i else None, ["user", None][i % 2], t, "x") for i, t in enumerate(turns)]
    return rows


def brute_trie(rebuilt):
    members = collections.defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    parents = {k[:-1] for k in members if k}
    leaves, saved, children = collections.Counter(), collections.Counter(), collections.Counter(k[:-1] for k in members if k)
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in parents
            saved[k[:d]] += (len(m) - 1) * (len(k[-1][1].encode()) if k else 0)
    digest = lambda k, m: hashlib.sha256(",".join(str(c) for c in m if rebuilt[c] == k).encode()).hexdigest()
    return sorted(((m[0], len(k), members[k[:-1]][0] if k else -1, len(m), children[k], leaves[k], saved[k], digest(k, m)) for k, m in members.items()))


def nodes(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


@pytest.mark.parametrize("chunk", [3, 4096])
def test_trie_of_rebuilt_conversations(spark, chunk, monkeypatch):
    # short chunks send the end lists through the chain
    monkeypatch.setattr(trie, "CHUNK", chunk)
    rows = [r for r in conversations(1) if r[0] not in (5, 20)] + [(None, 1, "user", "no conversation", "x")]
    own = collections.defaultdict(list)
    for c, _, role, text, _ in rows:
        own[c].append((role or "", text or ""))
    del own[None]
    rebuilt = {c: tuple(own.get(c - c % 5, [])[: zlib.crc32(str(c).encode()) % 9] + own[c][zlib.crc32(str(c).encode()) % 9 :]) for c in own}
    assert any(not x for x in rebuilt.values())
    got = trie.prefix_trie(*trie.rebuilt(trie.turn_rows(spark.createDataFrame(random.Random(2).sample(rows, len(rows)), TURNS))))
    assert nodes(got) == brute_trie(rebuilt)


def test_trie_as_it_is_and_what_is_left(spark):
    rows = conversations(3, 25)
    own = collections.defaultdict(list)
    for c, _, role, text, _ in rows:
        own[c].append((role or "", text or ""))
    own = {c: tuple(x) for c, x in own.items()}
    df = spark.createDataFrame(rows, TURNS)
    assert nodes(trie.conversation_trie(df)) == brute_trie(own)
    left = {r.conv_id: (r.n_turns, r.weight) for r in trie.training_sequences(df).collect()}
    sequences = collections.Counter(own.values())
    want = {min(c for c in own if own[c] == s): (len(s), n) for s, n in sequences.items() if not any(len(o) > len(s) and o[: len(s)] == s for o in sequences)}
    assert left == want
    assert trie.conversation_trie(df.limit(0)).count() == 0
    # equal turns of one conversation stand in the order of their content, whatever order they come in
    twice = [(1, 1, "user", "b", "x"), (1, 1, "user", "a", "x"), (2, 1, "user", "a", "x"), (2, 1, "user", "b", "x")]
    assert {r.depth: r.n_convs for r in trie.conversation_trie(spark.createDataFrame(twice, TURNS)).collect()} == {0: 2, 1: 2, 2: 2}


P = pytest.importorskip("public_tokenizers")
TEXTS = [None, "", " ", "Hello  world,\n\n it's 12½ o'clock\t!", "naïve café — “quoted” €5 Ærø", "漢字とかな 　 mixed", "a<|endoftext|>b", "x" * 30_000, "tab\x1cfile\x85next\xa0end", "Same", "Same", "é combined ﬁ ǆ ɑʯ", "  lead", "trail  ", "A\r\nB 'tis we'll 'S"]


def test_token_files_are_an_exact_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    file = P.path("byte_bpe_50k.json")
    rows = [(i * 3, t, "x", 7) for i, t in enumerate(TEXTS)] + [(9, "again", "x", 7), (None, "no id", "x", 7)]
    docs = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "doc_id long, text string, part string, start long")
    path = str(tmp_path / "t")
    write_token_files(docs, path, file)
    plain = Tokenizer.from_file(file)
    ids = {(i, t): plain.encode(t or "", add_special_tokens=False).ids + [0] for i, t, _, _ in rows}
    got = read_token_files(spark, path).collect()
    assert sorted((r.doc_id or -1, r.ids) for r in got) == sorted((i or -1, x) for (i, _), x in ids.items())
    before = 0
    for r in sorted(got, key=lambda r: (r.start)):
        assert (r.start, r.n_tokens) == (before, len(r.ids))
        before += r.n_tokens
    at = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert at == sorted(at) and before == sum(map(len, ids.values()))
    sums = {(r.doc_id, r.ids_crc32) for r in with_crc32(read_token_files(spark, path)).select("doc_id", "ids_crc32").collect()}
    assert sums == {(i, zlib.crc32(np.array(x, "<u4").tobytes())) for (i, _), x in ids.items()}
    for name in glob.glob(f"{path}/tokens/*.parquet"):
        group = pq.ParquetFile(name).metadata.row_group(0)
        coded = {group.column(i).path_in_schema: (group.column(i).encodings, group.column(i).has_column_index and group.column(i).has_offset_index) for i in range(group.num_columns)}
        assert "RLE_DICTIONARY" in coded["ids.list.element"][0] and coded["doc_id"][0] == coded["start"][0] == ("DELTA_BINARY_PACKED",) and all(x for _, x in coded.values())
    # counts are read without tokens, and a filter on doc_id reaches the files
    few = read_token_files(spark, path, ("doc_id", "n_tokens")).where("doc_id = 9")
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan and "EqualTo(doc_id,9)" in plan and few.count() == 2
    empty = str(tmp_path / "e")
    write_token_files(docs.limit(0), empty, file)
    assert with_crc32(read_token_files(spark, empty)).count() == 0


def test_remembered_cuts_come_back_from_the_older_half(spark):
    memory = CutIds(P.path("byte_bpe_50k.json"), bound=3)
    plain = memory.tokenizer
    for text in ["one two three four five", "two six one seven", "one two three four five"] * 2:
        assert np.frombuffer(memory.of(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert len(memory) <= 3


def merkle(rows, columns, presented, fanout):
    def h(*x):
        return hashlib.sha256("".join(x).encode()).hexdigest()

    def leaf(values):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    def build(level):
        out = [level]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
        return out

    def path(levels, i):
        for level in levels[:-1]:
            a = i // fanout * fanout
            yield level[a:i], level[i + 1 : a + fanout]
            i //= fanout

    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf([r[c] for c in columns]), leaf(presented(r))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [build([x[2] for x in sorted(groups[n])]) for n in names]
    top = build([t[-1][0] for t in trees])
    out = []
    for k, n in enumerate(names):
        for i, (known, doc_id, own, shown) in enumerate(sorted(groups[n])):
            steps = [*path(trees[k], i), *path(top, k)]
            for left, right in steps:
                shown = h(*left, shown, *right)
            out.append((doc_id if known else -1, own, trees[k][-1][0], top[-1][0], h(*[x for a, b in steps for x in (*a, *b)]), shown, shown == top[-1][0]))
    return sorted(out)


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_merkle_manifest(spark, fanout):
    rng = random.Random(fanout)
    rows = [{"doc_id": i, "source": rng.choice(["hot", "hot", "é", "a", "", None]), "h": rng.choice([None, "", "x", "ünder"]), "text": rng.choice([None, "", "Ab", "same"]), "level": "z"} for i in range(60)]
    rows += [rows[3], {**rows[3], "text": "other"}, {**rows[4], "doc_id": None}, {**rows[5], "source": "alone"}]
    columns = ["doc_id", "source", "h", "text"]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, source string, h string, text string, level string")
    shown = leaf_digest([F.lower(c) if c == "text" else F.col(c) for c in columns])
    got = merkle_manifest(df, columns, fanout=fanout, presented=shown).collect()
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = merkle(rows, columns, lambda r: [(r[c].lower() if c == "text" and r[c] is not None else r[c]) for c in columns], fanout)
    assert sorted((-1 if r.doc_id is None else r.doc_id, *[r[c] for c in names]) for r in got) == want
    assert {r.verified for r in got} == {True, False}
    assert merkle_manifest(df.limit(0), columns, fanout=fanout).count() == 0
    one = merkle_manifest(df.where("source = 'alone'"), columns, fanout=fanout).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == hashlib.sha256(b"").hexdigest()
