"""Every registered query over small whole tables with odd rows, and its digest columns against the
libraries or plain Python."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from postlens.llm.queries import QUERIES, tokenizer

SMALL = "/root/testdata/sf0.001"
ODD = {
    "documents": [(None, None), (None, "null id"), (900_001, ""), (900_002, " \n\t "), (900_003, "password = hunter22 token: abc123def AKIA" + "Q" * 20 + " " + "0f" * 14),
                  (900_003, "same id"), (900_004, "word " * 3000), (900_005, "Ünïcödé ñandú × ÷ 日本語 🙂" * 5)],
    "benchmark": [(None, "null item"), (900_001, None), (900_002, ""), (900_003, "same id")],
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    for name in ("documents", "benchmark", "pages", "labels", "conversations", "embeddings"):
        rows = spark.read.parquet(f"{SMALL}/{name}.parquet")
        if name in ODD:
            key = rows.columns[0]
            odd = spark.createDataFrame(ODD[name], f"{key} long, text string")
            rows = rows.unionByName(odd, allowMissingColumns=True)
        rows.write.parquet(f"{out}/{name}.parquet")
    return out


@pytest.fixture(scope="module")
def results(spark, folder):
    held = {}

    def of(name):
        if name not in held:
            held[name] = QUERIES[name](spark, folder).collect()
        return held[name]

    return of


@pytest.fixture(scope="module")
def documents(spark, folder):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def encoded(name, documents, end=None):
    whole = Tokenizer.from_file(tokenizer(name))
    whole.no_padding()
    whole.no_truncation()
    made = whole.encode_batch([t for _, t in documents], add_special_tokens=False)
    return [(i, e.ids + ([] if end is None else [end])) for (i, _), e in zip(documents, made, strict=True)], whole


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_every_query_runs(results):
    for name in QUERIES:
        rows = results(name)
        assert rows, name
        assert len(set(rows[0].__fields__)) == len(rows[0].__fields__), name


def test_packing_digest(results, documents):
    ids, _ = encoded("byte_bpe_50k.json", documents, 0)
    pieces = sorted((str(p.doc_id), p.start, p.length, p.ids_crc32, p.doc_tokens) for p in results("op1_lexical_packing"))
    assert sum(p[2] for p in pieces) == sum(len(x) for _, x in ids)
    known = {i: x for i, x in ids if i is not None and sum(1 for j, _ in ids if i == j) == 1}
    for doc, start, length, digest, total in pieces:
        if doc != "None" and int(doc) in known:
            own = known[int(doc)]
            assert digest == crc(own[start : start + length]) and total == len(own)
    rows = results("op1_lexical_packing")
    held: dict = {}
    for p in rows:
        held.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_bpe_digests(results, documents):
    ids, whole = encoded("word_bpe_49k.json", documents)
    want = sorted((str(i), len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(whole.decode(x, skip_special_tokens=False).encode()).hexdigest()) for i, x in ids)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in results("op4_rank_bpe")) == want


def test_token_file_digests(results, documents):
    ids, _ = encoded("word_bpe_49k.json", documents, 1)
    rows = sorted(results("op7_token_files"), key=lambda r: r.start)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows) == sorted((str(i), len(x), crc(x)) for i, x in ids)
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows]).tolist()[:-1]]
    told = [r.doc_id for r in rows if r.doc_id is not None]
    assert told == sorted(told)


def test_fingerprint_digits(results, documents):
    rows = results("op5_simhash_anchors")
    assert len(rows) == len(documents) and all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in rows)
    empty = {r.doc_id for r in rows if r.fingerprint == "0" * 16}
    assert {900_001, 900_002, None} <= empty
    assert len({r.component_id for r in rows if r.doc_id in (900_001, 900_002)}) == 1


PATTERNS = {
    "assign": r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"(AKIA[A-Z0-9]+)", "hex": r"([0-9a-f]+)",
}
LEAST = {"assign": 6, "access": 20, "hex": 24}


def test_secret_spans_against_a_plain_scan(results, documents):
    want = []
    for doc, text in documents:
        found = [(m.start(), n, m.end(), kind) for n, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if len(m[1]) >= LEAST[kind]]
        base = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))
        want.append((str(doc), *(sum(f[3] == k for f in found) for k in PATTERNS), hashlib.sha256(base.encode()).hexdigest(), base))
    rows = results("op6_secret_ownership")
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows) == sorted(w[:5] for w in want)
    spans = {w[0]: w[5] for w in want if w[0] not in ("None", "900003")}
    for r in rows:  # the method adds spans, base ones stay in order
        if str(r.doc_id) in spans:
            kept = [s for s in r.spans.split(",") if s.split(":")[0] in PATTERNS]
            assert ",".join(kept) == spans[str(r.doc_id)]


def test_search_is_exact_where_it_returns(results, spark, folder):
    vectors = {r.vec_id if "vec_id" in r.__fields__ else r.id: np.array(r[1], np.float64) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    rows = results("op10_hilbert_search")
    queries = {r.query_id for r in rows}
    assert queries == {i for i in vectors if i % 100 == 0}
    right = 0
    for q in queries:
        mine = sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, len(mine) + 1))
        for r in mine:
            assert abs(r.score - float(np.sqrt(((vectors[q] - vectors[r.vec_id]) ** 2).sum()))) < 1e-12
        best = sorted((float(np.sqrt(((vectors[q] - v) ** 2).sum())), i) for i, v in vectors.items() if i != q)[:10]
        right += len({i for _, i in best} & {r.vec_id for r in mine})
    assert right >= 0.9 * 10 * len(queries)
