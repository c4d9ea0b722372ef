"""Near copies by signatures, dataset manifests and prefix tries against brute force; words and tables that once went wrong."""

import collections
import hashlib
import random
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import shotframe.llm.jaccard_join as jaccard
import shotframe.llm.minhash as minhash
import shotframe.llm.substring_dedup as dedup
from shotframe.llm import merkle, windows
from shotframe.llm.jaccard_join import jaccard_join
from shotframe.llm.langid import fit, held_out, language_id
from shotframe.llm.merkle import merkle_manifest, with_folded
from shotframe.llm.minhash import minhash_near_dedup
from shotframe.llm.prefix_trie import grafted, numbered_turns, prefix_trie
from shotframe.llm.substring_dedup import substring_dedup
from shotframe.llm.token_count import token_counts
from shotframe.llm.tokens import WordEncoder, alphabet, vocabulary

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


# 11


def brute_components(rows, k):
    sets = {}
    for i, text in rows:
        w = words_of((text or "").translate(LOW))
        sets[i] = frozenset(zip(*[w[j:] for j in range(k)], strict=False)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and root[a] != root[b] and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root[a], root[b]))
                root = {i: x if r == y else r for i, r in root.items()}
    return {i: (len(s), root[i]) for i, s in sets.items()}


def test_signatures_within_distance_share_a_key():
    rng = np.random.default_rng(3)
    assert sum(len(c) for c in minhash.chunks(128, 49)) == 128 and len(minhash.chunks(128, 49)) == 25
    for _ in range(200):
        a = rng.integers(0, 256, (1, 128), dtype=np.uint8)
        b = a.copy()
        at = rng.choice(128, 49, replace=False)
        b[0, at] ^= rng.integers(1, 256, 49, dtype=np.uint8)
        keys = list(minhash.chunk_keys(np.concatenate((a, b))))
        assert len(keys) == 128 and any(k[0] == k[1] for k in keys)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(4)
    h = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    for shared in (0, 1000, 1800):
        a, b = h[:2000], h[2000 - shared : 4000 - 2 * shared if shared < 1000 else 4000 - shared]
        a, b = h[:2000], np.concatenate((h[:shared], rng.integers(0, 1 << 63, 2000 - shared).astype(np.uint64)))
        s = minhash.signatures(np.concatenate((a, b)), np.array([2000, 2000]))
        assert abs((s[0] == s[1]).mean() - shared / (4000 - shared)) < 0.15


def test_first_shared_key():
    rng = np.random.default_rng(7)
    x = rng.integers(0, 4, (300, 128), dtype=np.uint8)
    y = np.where(rng.random((300, 128)) < 0.3, rng.integers(0, 4, (300, 128)), x).astype(np.uint8)
    same = np.stack(list(minhash.chunk_keys(x))) == np.stack(list(minhash.chunk_keys(y)))
    want = np.where(same.any(0), same.argmax(0), -1)
    assert np.array_equal(minhash._first_shared(x, y, 49), want) and (want >= 0).any()
    z = (x + 1).astype(np.uint8)
    assert set(minhash._first_shared(x, z, 49)) == {-1}


@pytest.mark.parametrize("block", [1_000_000, 600])
def test_minhash_near_dedup_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", block)  # the smaller one: a few documents a block, keys that repeat in it
    rng = random.Random(11)
    base = [[f"w{rng.randrange(400)}" for _ in range(n)] for n in (1, 2, 4, 9, 30, 60, 200)]
    rows = []
    for b in base:
        for _ in range(14):
            w = list(b)
            for _ in range(rng.randrange(1 + len(b) // 14)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(30)}"
            rows.append((len(rows) * 3, (" " if rng.random() < 0.5 else "\n").join(w).upper() if rng.random() < 0.3 else " ".join(w)))
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "one"), (1004, "ONE "), (None, rows[-1][1])]
    rows += rows[:5]  # repeated rows
    made = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id long, text string, sig string, key int").repartition(3)
    got = minhash_near_dedup(made).collect()
    want = brute_components({i: t for i, t in rows if i is not None}.items(), 2)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert len(got) == len(want) + 1 and all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert [(r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, None, True)]


def test_minhash_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert minhash_near_dedup(none).count() == 0
    nulls = spark.createDataFrame([(None, "a b c"), (None, None)], "doc_id long, text string")
    assert [r.kept for r in minhash_near_dedup(nulls).collect()] == [True, True]
    two = spark.createDataFrame([(1, "a b c"), (1, "d e f g"), (2, "a b c"), (3, "d e f g")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash_near_dedup(two).collect()}
    assert got in ({1: 1, 2: 1, 3: 3}, {1: 1, 2: 2, 3: 1})  # one text stands for the id


# 12


def brute_levels(nodes, levels=None):
    out = [list(nodes)]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


@pytest.mark.parametrize("levels", [None, 5])
def test_traversal_gives_every_path(levels):
    for m in [*range(1, 40), 80, 81, 82, 242, 243]:
        leaves = [sha(str(i)) for i in range(m)]
        nodes = brute_levels(leaves, levels)
        high = len(nodes) - 1
        assert merkle.climbed(leaves, high) == nodes[-1][0] and len(nodes[-1]) == 1
        for i, path in enumerate(merkle.traversed(leaves, high)):
            for h, (left, right) in enumerate(path):
                at, run = i // 3**h, i // 3 ** (h + 1)
                assert left == nodes[h][3 * run : at] and right == nodes[h][at + 1 : 3 * run + 3]


def test_treehash_keeps_few_nodes():
    stack = merkle.Treehash(9)
    for i in range(20_000):
        stack.add(str(i))
        assert sum(map(len, stack.runs)) <= 18


def test_manifest_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", "é", "", None]), f"t\n{i}" if i % 4 else None, None if i % 5 else "en", i) for i in range(60)]
    rows += [(100 + i, "hot", "x", "de", None) for i in range(800)]  # three blocks and a rest, two steps of levels
    rows += [(None, "b", "one", None, 1), (None, "b", "two", None, 1), (7, "lone", "", "", 0), (7, "b", "again", None, 2), *[(8, "b", "same", None, 2)] * 3]
    made = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, source string, text string, lang string, n_chars long, path string").repartition(4)
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = collections.defaultdict(list)
    for i, source, text, lang, n in rows:
        groups[source].append(((i is not None, i or 0), sha("".join(map(field, (i, source, lang, n, text)))), i))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_levels([leaf for _, leaf, _ in sorted(groups[s])]) for s in names}
    top = brute_levels([trees[s][-1][0] for s in names])
    want = collections.Counter()
    for k, s in enumerate(names):
        for at, (_, leaf, i) in enumerate(sorted(groups[s])):
            proof = ""
            for nodes, place in ((trees[s], at), (top, k)):
                for h in range(len(nodes) - 1):
                    run = place // 3 ** (h + 1)
                    proof += "".join(x for j, x in enumerate(nodes[h][3 * run : 3 * run + 3], 3 * run) if j != place // 3**h)
            want[i, leaf, trees[s][-1][0], top[-1][0], proof] += 1
    got = with_folded(merkle_manifest(made, also=F.col("text")), "leaf").collect()
    assert collections.Counter((r.doc_id, r.leaf, r.subroot, r.root, re.sub("[:/]", "", r.path)) for r in got) == want
    assert all(r.folded_root == r.root for r in got)
    broken = with_folded(merkle_manifest(made).withColumn("other", F.sha2(F.col("leaf").cast("binary"), 256)), "other").collect()
    assert len(broken) == len(rows) and not any(r.folded_root == r.root for r in broken)


def test_manifest_of_nothing_and_of_one_row(spark):
    schema = "doc_id long, source string, text string, lang string, n_chars long"
    assert merkle_manifest(spark.createDataFrame([], schema)).count() == 0
    (r,) = with_folded(merkle_manifest(spark.createDataFrame([(None, None, None, None, None)], schema)), "leaf").collect()
    assert r.leaf == r.subroot == r.root == r.folded_root == sha("-----") and r.path == ""


# 13


def brute_trie(rows, hundred=100, taken=lambda c: zlib.crc32(str(c).encode()) % 6):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    built = {c: tuple(own.get(c - c % hundred, [])[: taken(c)] + v[taken(c) :]) for c, v in own.items()}
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    for node, ids in members.items():
        below, todo = [], [node]
        while todo:
            x = todo.pop()
            below.append(x)
            todo += children[x]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = ",".join(str(c) for c in sorted(ids) if len(built[c]) == len(node))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children[node]), sum(not children[x] for x in below), saved, sha(ends)))
    return sorted(out, key=repr)


def trie_rows(spark, rows, hundred=100):
    made = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(3)
    conv = F.col("conv")
    out = prefix_trie(*grafted(numbered_turns(made), conv - conv % hundred, F.crc32(conv.cast("string").cast("binary")) % 6)).collect()
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in out), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(260), 120):
        for turn in range(rng.randrange(1, 9)):
            rows.append((c, None if rng.random() < 0.1 else turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "ccc"])))
    rows += [(1000 + c, t, "user", "long chain") for c in range(6) for t in range(12 + c)]  # each is a prefix of the next
    rows += [(None, 0, "user", "lost"), *rows[:4], (2000, 0, "user", "twin"), (2001, 0, "user", "twin")]
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert trie_rows(spark, []) == []
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)  # all it has goes, and there is no base
    assert trie_rows(spark, [(c, 0, "user", "x")]) == brute_trie([(c, 0, "user", "x")]) == [(c, 0, None, 1, 0, 1, 0, sha(str(c)))]


# words of one structure


def thue_morse(n, flip=False):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048, 8192])
def test_words_of_one_structure_are_told_apart(spark, n):
    a, b = thue_morse(n), thue_morse(n, True)
    h, _ = windows.word_hashes([f"{a} {b} {a[:250]} {b[:250]}".encode()])
    assert len(set(h.tolist())) == 4
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        library = Tokenizer.from_file(vocabulary(name))
        want = [library.encode(t, add_special_tokens=False).ids for t in (a, b)]
        got = WordEncoder(vocabulary(name), alphabet(vocabulary(name))).encode([a, b])
        assert [x.tolist() for x in got] == want and want[0] != want[1]
    one, two = (" ".join([w, *[w[::-1][:300] + str(i) for i in range(13)]]) for w in (a, b))
    made = spark.createDataFrame([(1, one), (2, two), (3, f"{a} x y z {a}"), (4, f"{b} x y z {b}")], "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup(made).collect()] == [0] * 4
    assert all(r.component_id == r.doc_id for r in jaccard_join(made).collect())
    assert all(r.component_id == r.doc_id for r in minhash_near_dedup(made).collect())
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    counts = {r.doc_id: r.n_tokens for r in token_counts(made, vocabulary("byte_bpe_50k.json")).collect()}
    assert counts == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in made.collect()}


def test_span_hashes_see_every_byte():
    rng = np.random.default_rng(8)
    for size in (1, 7, 8, 9, 64, 255, 256, 257, 900):
        w = bytearray(rng.integers(97, 123, size, dtype=np.uint8).tobytes())
        made = {bytes(w)}
        for at in range(size):
            x = bytearray(w)
            x[at] ^= 1
            made.add(bytes(x))
        made |= {bytes(w[:k]) for k in range(1, size)}
        made = sorted(made)
        h, counts = windows.word_hashes([b" ".join(made)])
        assert counts.tolist() == [len(made)] and len(set(h.tolist())) == len(made)


# null ids, letters, names of columns


def test_language_of_letterless_numbers(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tree = fit(docs.where(~held_out()))
    made = spark.createDataFrame([(1, "½ ² ①"), (2, "Ⅷ ½"), (3, "Das ist ein Haus und es ist schön")], "doc_id long, text string")
    assert [r.lang_pred == "und" for r in language_id(made, tree).orderBy("doc_id").collect()] == [True, True, False]


def test_stages_keep_tables_of_null_ids(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    nameless = docs.withColumn("doc_id", F.lit(None).cast("long"))
    told = P.identify_language(spark, nameless, SF)
    assert told.count() == docs.count()
    rows = nameless
    for _, stage in P.STAGES[:-1]:
        rows = P.materialize(stage(spark, rows, SF))
    leaks = P.drop_benchmark_leaks(spark, docs, SF)
    assert rows.count() == leaks.count() > 0
    assert P.pack(spark, rows, SF).where("start = 0").count() == rows.count()


def test_stages_hand_on_clashing_columns_and_empty_tables(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ("score", "key", "spans", "clean", "known", "lang_pred", "id", "column_0", "a.b")
    wide = docs.select("*", *(F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in names))
    plain, rows, empty = docs, wide, wide.limit(0)
    for _, stage in P.STAGES[:-1]:
        plain, rows, empty = (P.materialize(stage(spark, x, SF)) for x in (plain, rows, empty))
        assert rows.columns == empty.columns == wide.columns and empty.count() == 0
        got = rows.collect()
        assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in plain.collect())
        assert all(r[c] == f"{c}{r.doc_id}" for r in got for c in names)
    assert P.pack(spark, empty, SF).count() == 0 < P.pack(spark, rows, SF).count()


# 4 and 8: blocks meet buckets


@pytest.mark.parametrize("n", [0, 1, 5, 1000])
def test_packed_rows(n):
    rng = np.random.default_rng(n)
    at = windows.cuts(np.sort(rng.integers(0, 9, n)))
    a = rng.integers(0, 2**64 - 1, n, dtype=np.uint64, endpoint=True) >> rng.integers(0, 64, n).astype(np.uint64)
    a[:2] = [0, 2**64 - 1][:n]
    ids = a.view(np.int64).copy()
    ids[2:4] = [-(2**63), 2**63 - 1][: max(0, n - 2)]
    h = a & np.uint64(2**56 - 1) | np.uint64(0xAB << 56)
    numbers, signed, hashes = windows.packed_numbers(a, at), windows.packed_ids(ids, at), windows.packed_hashes(h, at)
    for column in (numbers, signed, hashes):
        column.validate(full=True)
        assert len(column) == len(at) - 1
    assert np.array_equal(windows.unpacked_numbers(numbers), a) and np.array_equal(windows.unpacked_ids(signed), ids)
    assert np.array_equal(windows.unpacked_hashes(hashes, 0xABC, 12), h) and np.array_equal(windows.unpacked(windows.packed(a, at), np.uint64), a)
    if len(at) > 3:  # rows in pieces, and from the middle
        pieces = pa.chunked_array([signed.slice(1, 1), signed.slice(2)])
        assert np.array_equal(windows.unpacked_ids(pieces), ids[at[1] :])
        assert np.array_equal(windows.unpacked_numbers(numbers.slice(2)), a[at[2] :])


def calls_of(f):
    """Steps of Python that f takes."""
    n = 0

    def count(frame, event, arg):
        nonlocal n
        n += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        f()
    finally:
        sys.setprofile(None)
    return n


def block_functions(spark, monkeypatch, module, make, bits):
    """The function that makes a block's rows and the one that reads a bucket's, for so many bits of buckets."""
    seen = []
    docs = spark.createDataFrame([(1, "")], "doc_id long, text string")
    for kind, name in ((type(docs), "mapInArrow"), (type(docs.groupBy("doc_id")), "applyInArrow")):
        f = getattr(kind, name)
        monkeypatch.setattr(kind, name, lambda self, own, *a, f=f, **b: seen.append(own) or f(self, own, *a, **b))
    monkeypatch.setattr(module, "bucket_bits", lambda n: bits)
    monkeypatch.setattr(module, "materialize", lambda df, tag: df)
    make(docs.withColumnRenamed("doc_id", "id"))
    monkeypatch.undo()
    return seen[:2]


def several_groups(n, seed):
    """A record batch of n texts of which some share lines."""
    rng = random.Random(seed)
    line = [" ".join(f"w{rng.randrange(9999)}" for _ in range(30)) for _ in range(20)]
    texts = [" ".join(rng.choices(line, k=3) + [f"x{rng.randrange(10**9)}" for _ in range(60)] + [line[0]]) for _ in range(n)]
    return pa.RecordBatch.from_pydict({"id": list(range(n)), "text": texts})


def assert_no_step_a_bucket(spark, monkeypatch, module, make):
    """Neither the rows of a block nor those of a bucket may cost a step of Python each: as more input has more blocks and
    more buckets, they grow with its square."""
    batch, took = several_groups(400, 1), {}
    for bits in (8, 14):
        block, bucket = block_functions(spark, monkeypatch, module, make, bits)
        took[bits] = calls_of(lambda block=block: list(block(iter([batch]))))
        if bits == 8:
            rows = pa.Table.from_batches(block(iter([batch])))
            first = rows.filter(pc.equal(rows.column("bucket"), pc.max(rows.column("bucket"))))
            bucket(first)
            once = calls_of(lambda bucket=bucket, first=first: bucket(first))
            again = pa.concat_tables([first] * 200)
            many = calls_of(lambda bucket=bucket, again=again: bucket(again))
            assert many < 1.5 * once + 200
    assert took[14] < 1.2 * took[8]


def test_jaccard_blocks_take_no_step_a_bucket(spark, monkeypatch):
    assert_no_step_a_bucket(spark, monkeypatch, jaccard, lambda docs: jaccard.shared_shingles(docs, 5, 80))


def test_jaccard_join_does_not_depend_on_buckets(spark, monkeypatch):
    docs = spark.createDataFrame(several_groups(150, 2).to_pylist() + [{"id": 7, "text": "another text of seven"}, {"id": -5, "text": None}], "id long, text string").cache()
    want = sorted(map(tuple, jaccard_join(docs.where("id <> 7"), id_col="id", links=True).collect()))
    for bits, hot in ((11, 64), (11, 3)):
        monkeypatch.setattr(jaccard, "bucket_bits", lambda n, bits=bits: bits)
        monkeypatch.setattr(jaccard, "HOT", hot)
        assert sorted(map(tuple, jaccard_join(docs.where("id <> 7"), id_col="id", links=True).collect())) == want
    assert len(jaccard_join(docs, id_col="id", links=True).collect()) == 151  # an id of two texts is one row
    docs.unpersist()

def test_substring_blocks_take_no_step_a_bucket(spark, monkeypatch):
    assert_no_step_a_bucket(spark, monkeypatch, dedup, lambda docs: substring_dedup(docs, id_col="id"))


def test_substring_dedup_does_not_depend_on_buckets(spark, monkeypatch):
    docs = spark.createDataFrame([*several_groups(150, 3).to_pylist(), {"id": -5, "text": None}, {"id": None, "text": "a b"}, {"id": -(2**63), "text": " ".join("abcdefghijklmnop")}], "id long, text string").cache()
    key = lambda df: sorted((map(str, df.collect())))
    want = key(substring_dedup(docs, id_col="id"))
    assert sum("Row(start=" in x for x in want) > 100
    monkeypatch.setattr(dedup, "bucket_bits", lambda n: 11)
    assert key(substring_dedup(docs, id_col="id")) == want
    docs.unpersist()
