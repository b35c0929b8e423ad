"""Whitening, segment-tree BPE and the Merkle manifest against brute force, and on awkward rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from conftest import SMALL
from rainledger.llm import merkle, registry, segment_bpe, whitening
from test_llm_operators import AWKWARD

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, "en" if n % 2 else None, f"s{n % 3}" if n % 4 else None, n, "x", 2) for n, (i, t) in enumerate(AWKWARD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, tree string, pos int")


# --- whitening ----------------------------------------------------------------------------------


def brute_whitening(vectors, components=16, scale=64):
    """Deviation per row, axes and variances of one length of vectors, in Python integers."""
    rows = [[int(np.floor(scale * np.float64(c))) + 1_000_000 for c in v] for v in vectors]
    fit = sorted(set(map(tuple, rows)))
    n, dim = len(fit), len(rows[0])
    sums = [sum(v[d] for v in fit) for d in range(dim)]
    deviation = [sum((n * x - s) ** 2 for x, s in zip(v, sums)) for v in rows]
    centred = np.array([[n * x - s for x, s in zip(v, sums)] for v in fit], dtype=np.float64) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    own = np.array([[n * x - s for x, s in zip(v, sums)] for v in rows], dtype=np.float64) / n
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return n, deviation, own @ axes / np.sqrt(values), values / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("reach", [3, 200, 1 << 30, 1 << 50])
def test_planes_give_exact_products(reach):
    values = np.random.default_rng(1).integers(-reach, reach, (333, 7))
    values[:, 3] = 5
    sums, products = whitening.scatter(values)
    whole = values.astype(object)
    assert (sums == whole.sum(axis=0)).all() and (products == whole.T @ whole).all()


def test_planes_give_back_the_values():
    values = np.random.default_rng(2).integers(0, 1000, (130, 5))
    planes, columns, bits = whitening.bit_planes(values)
    back = np.zeros((192, 5), dtype=np.int64)
    for plane, column, bit in zip(planes, columns, bits):
        back[:, column] += np.unpackbits(plane.view(np.uint8), bitorder="little").astype(np.int64) << bit
    assert (back[:130] == values).all() and not back[130:].any()


@pytest.mark.parametrize("block_rows", [37, whitening.BLOCK_ROWS])
def test_whitening_equals_brute_force(spark, block_rows):
    source = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    source = [r for r in source if r["embedding"] is not None and all(c is not None and np.isfinite(c) for c in r["embedding"])]
    n, deviation, white, share = brute_whitening([r["embedding"] for r in source])
    found = {(r["vec_id"], r["component"]): r for r in whitening.whiten(registry.read(spark, SMALL, "embeddings"), block_rows=block_rows).collect()}
    assert len(found) == 16 * len(source)
    signs = np.sign([[found[r["vec_id"], c + 1]["whitened"] for c in range(16)] for r in source] * white).sum(axis=0)
    for i, row in enumerate(source):
        for c in range(16):
            out = found[row["vec_id"], c + 1]
            assert (out["n"], out["deviation"]) == (n, deviation[i])
            assert out["whitened"] == pytest.approx(white[i, c] * np.sign(signs[c]), abs=1e-6)
            assert out["explained"] == pytest.approx(share[c], rel=1e-6) and out["identity_error"] < 1e-6
    assert set(np.abs(signs)) == {len(source)}


def test_whitening_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 0), (2, [], 0), (3, [1.0, None], 0), (4, [1.0, nan], 0), (5, [inf, 1.0], 0), (6, [-inf, 1.0], 0),
        (7, [0.5, 1.5], 1), (7, [0.5, 1.5], 1), (None, [-0.5, 4.0], 1), (9, [2.0, -3.0], 1), (10, [0.501, 1.501], 1),
        (11, [1.0, 2.0, 3.0], 1), (12, [1e12, -1e12, 0.0, 1.0], 1), (13, [-1e12, 3.0, 0.0, 1.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, dim int")
    found = defaultdict(list)
    for r in whitening.whiten(df, 2).collect():
        found[r["vec_id"]].append(r)
    assert set(found) == {7, None, 9, 10, 11, 12, 13} and [len(found[i]) for i in (7, None, 11)] == [4, 2, 2]
    n, deviation, white, _ = brute_whitening([[0.5, 1.5], [-0.5, 4.0], [2.0, -3.0]], 2)
    for i, key in enumerate([7, None, 9]):
        for r in found[key]:
            assert (r["n"], int(r["deviation"])) == (3, deviation[i]) and r["identity_error"] < 1e-9
            assert abs(r["whitened"]) == pytest.approx(abs(white[i, r["component"] - 1]), abs=1e-9)
    # floor(64 * 0.501) is 32, as of 0.5: a copy, fitted on once.
    assert {r["component"]: r["whitened"] for r in found[10]} == {r["component"]: r["whitened"] for r in found[7]}
    # One distinct vector has no variance.
    assert {(r["n"], int(r["deviation"]), r["whitened"], r["identity_error"]) for r in found[11]} == {(1, 0, None, None)}
    wide = brute_whitening([[1e12, -1e12, 0.0, 1.0], [-1e12, 3.0, 0.0, 1.0]], 2)
    assert [int(found[i][0]["deviation"]) for i in (12, 13)] == wide[1]
    assert [r["whitened"] is None for r in sorted(found[12], key=lambda r: r["component"])] == [False, True]
    assert whitening.whiten(df.limit(0)).count() == 0


# --- segment-tree BPE ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def bpe():
    return segment_bpe.SegmentBpe(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def test_segment_tree_encodes_as_the_library(spark, library):
    found = {r["doc_id"]: tuple(r)[1:] for r in registry.op12_segment_tree_bpe(spark, SMALL).collect()}
    for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        text = row["text"] or ""
        ids = library.encode_ordinary(text)
        assert found[row["doc_id"]] == (len(ids), sha(" ".join(map(str, ids))), sha(text))


def test_segment_tree_on_mixed_texts(bpe, library):
    rng = random.Random(5)
    # Letters and digits of several versions of Unicode, white space of all kinds, contractions, runs.
    pool = list("abcABC  \n\t'.,!?019éßΣς中文 　՘ꟋᲉᲊ\x85\x1c\x1f﻿\U00011de0😀ا́ñ ")
    pool += ["'s", "'ll", " the", "ing", "  ", "\r\n"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["a" * 3000, "ab" * 700 + "中" * 300, " " * 900, "\n" * 257, "".join(rng.choice("abcdefgh") for _ in range(6000))]
    for _ in range(2):  # the second time from memory
        for text, ids in zip(texts, bpe.encode(texts)):
            ids = np.frombuffer(ids, dtype="<u4").astype(np.int64)
            assert ids.tolist() == library.encode_ordinary(text)
            assert bpe.decode(ids).tobytes() == text.encode()


@pytest.mark.parametrize("size", [1, 2, 3, 8, 9, 31, 64])
def test_matrix_of_trees_equals_single_trees(bpe, size):
    rng = np.random.default_rng(size)
    pieces = [bytes(rng.integers(97, 105, size, dtype=np.uint8)) for _ in range(50)]
    assert bpe._merge_rows(pieces, (size - 1).bit_length()) == [bpe._merge_long(piece) for piece in pieces]


def test_full_memory_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(segment_bpe, "MEMORY", 3)
    small = segment_bpe.SegmentBpe(RANKS, public_tokenizers.PATTERN)
    texts = ["one two three four five six", "six five  four three two one", "x" * 500 + " two"]
    for text in texts * 2:
        assert np.frombuffer(small.encode([text])[0], dtype="<u4").tolist() == library.encode_ordinary(text)


def test_segment_tree_on_awkward_rows(spark, awkward, library):
    rows = segment_bpe.encode_and_decode(awkward, RANKS, public_tokenizers.PATTERN).collect()
    wanted = sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in AWKWARD), key=str)
    assert sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in rows), key=str) == wanted
    assert all(r["n_tokens"] == len(r["ids"]) for r in rows)
    assert segment_bpe.encode_and_decode(awkward.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


# --- Merkle manifest ----------------------------------------------------------------------------


def up(nodes, arity=3):
    return [sha("".join(nodes[i : i + arity])) for i in range(0, len(nodes), arity)]


def proof_of(nodes, at, arity=3):
    """Siblings level by level as (own place in the run, run without it), and the root."""
    way = []
    while len(nodes) > 1:
        first = at - at % arity
        run = nodes[first : first + arity]
        way.append((at - first, run[: at - first] + run[at - first + 1 :]))
        nodes, at = up(nodes, arity), at // arity
    return way, nodes[0]


def brute_manifest(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (doc_id, source, lang, n_chars, text)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha("".join(map(field, r)))
    trees = defaultdict(list)
    for r in rows:
        trees[r[1]].append(r)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is None, r[0] or 0, leaf(r)))
    subroots = [proof_of([leaf(r) for r in trees[name]], 0)[1] for name in names]
    out = []
    for place, name in enumerate(names):
        upper, root = proof_of(subroots, place)
        leaves = [leaf(r) for r in trees[name]]
        for at, r in enumerate(trees[name]):
            way = proof_of(leaves, at)[0] + upper
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = leaf((*r[:4], r[4].replace("\n", ""))) if even and r[4] is not None else leaves[at]
            for own, others in way:
                node = sha("".join(others[:own] + [node] + others[own:]))
            proof = sha("".join(x for _, others in way for x in others))
            out.append((r[0], leaves[at], subroots[place], root, proof, node, node == root))
    return out


def key(row):
    return tuple(map(str, row))


def rows_of(df):
    return [tuple(r) for r in df.select(*merkle.FIELDS).collect()]


@pytest.mark.parametrize("depth", [1, 2, 7])
def test_manifest_equals_brute_force(spark, depth):
    """Also with blocks of 3 and 9 nodes, so that several stored levels of both trees are used."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [tuple(r) for r in merkle.manifest(docs, depth).collect()]
    wanted = brute_manifest(rows_of(docs))
    assert sorted(found, key=key) == sorted(wanted, key=key)
    assert {r[6] for r in found} == {True, False}


def test_manifest_of_many_sources(spark):
    rows = [(i, f"s{i * i % 41}" if i % 7 else None, "en", i, f"a\n{i}") for i in range(120)]
    rows += [(200 + i, name, None, None, "x\ny") for i, name in enumerate(["", "é", "z", "😀", "=", "￿"])]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    found = [tuple(r) for r in merkle.manifest(df, 1).collect()]
    assert sorted(found, key=key) == sorted(brute_manifest(rows), key=key)


@pytest.mark.parametrize("size", [0, 1, 2, 3, 4, 10, 28])
def test_manifest_of_small_tables(spark, size):
    rows = [(i, "s", "en", 1, "a\nb") for i in range(size)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert sorted((tuple(r) for r in merkle.manifest(df).collect()), key=key) == sorted(brute_manifest(rows), key=key)


def test_manifest_of_awkward_rows(spark, awkward):
    found = [tuple(r) for r in merkle.manifest(awkward).collect()]
    assert sorted(found, key=key) == sorted(brute_manifest(rows_of(awkward)), key=key)


def test_a_version_shares_all_but_its_own_ancestors():
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(20)]
    tree = merkle.Tree(leaves, 3)
    other = hashlib.sha256(b"other").digest()
    for at in range(20):
        changed = merkle.Tree([other if i == at else x for i, x in enumerate(leaves)], 3)
        copies = tree.version(at, other)
        assert copies[-1] == changed.root and tree.root != changed.root
        for level, (old, new) in enumerate(zip(tree.levels, changed.levels)):
            assert [i for i in range(len(old)) if old[i] != new[i]] == [at // 3**level] and new[at // 3**level] == copies[level]
