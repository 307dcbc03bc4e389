import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rowsentry.llm import token_alignment as t

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
DDL = "doc_id LONG, text STRING, block STRING, n_a STRING"
NASTY = [None, "", " ", "a", "  two  spaces ", "Hello world. It's 3.14, isn't it?", "naïve café été où ça", "漢字 かな ひらがな", "🙂🙃 ok", "a▁b c", "▁",
         "<|endoftext|> <s> <unk> </s>", "tab\there\n\nnew  \n line", "nul\x00 byte", "x" * 3000, "ab " * 500, "   x y", "é é z",
         "Ŀ ŀ ǅ x \u0085 y", "1 2 33 444 5555", "don't DON'T 'S 's", "=" * 100 + " - " + "#" * 77, "　 full width", "мир труд май", "a ß é b"]


def plain(texts):
    """The contract word by word: whole texts through both libraries, byte offsets, all token pairs of each group."""
    a_tok, b_tok = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a_tok.encode_special_tokens = True
    points = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(p): p for p in points} | {chr(256 + k): p for k, p in enumerate(sorted(set(range(256)) - set(points)))}

    def b_bytes(i):
        p = b_tok.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    made, documents = [], Counter()
    for text in texts:
        if not text:
            made.append(None)
            continue
        a = a_tok.encode(" " + text, add_special_tokens=False).ids
        b = b_tok.encode(text)
        pieces = [[bytes(byte_of[c] for c in a_tok.id_to_token(i)) for i in a], [b_bytes(i) for i in b]]
        if any(b"".join(p) != (" " + text).encode() for p in pieces):
            made.append(None)
            continue
        ends = [np.cumsum([len(x) for x in p]).tolist() for p in pieces]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j = [], 0, 0
        for c in common:
            u, v = ends[0].index(c, i) + 1, ends[1].index(c, j) + 1
            groups.append((a[i:u], b[j:v]))
            i, j = u, v
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        documents.update(links.keys())
        made.append((a, b, groups, links))
    best = defaultdict(int)
    for (x, _), n in documents.items():
        best[x] = max(best[x], n)
    out = []
    for m in made:
        if m is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = m
        said = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((len(a), len(b), len(groups), sum(links.values()), sum(n for k, n in links.items() if documents[k] == best[k[0]]),
                    sum(n * documents[k] for k, n in links.items()), said))
    return out


def check(spark, texts, parts=3, **how):
    df = spark.createDataFrame([(i, x, "own", "other") for i, x in enumerate(texts)], DDL).repartition(parts)
    out = t.align(df, *PATHS, **how)
    assert "block" in out.columns and out.columns.count("n_a") == 1
    got = {r["doc_id"]: tuple(r[c] for c in t.OUTPUTS) for r in out.collect()}
    wanted = plain(texts)
    assert sorted(got) == list(range(len(texts)))
    for i, w in enumerate(wanted):
        assert got[i] == w, (texts[i] or "")[:60]


def test_whole_result_against_both_libraries(spark):
    check(spark, [*NASTY, *NASTY[5:9], " ".join(x for x in NASTY if x)])


def test_small_blocks_answer_alike(spark):
    check(spark, [*NASTY, *(["the cat sat. The café's door"] * 20)], parts=2, block_bytes=200)


def test_random_characters(spark):
    rng = np.random.default_rng(2)
    pool = [*"abc XYZ  019.,'-\n\t", *"éßÿ×÷ñ", " ", "́", "漢", "я", "▁", "🙂", " ", "İ", "ǅ", "க"]
    check(spark, ["".join(rng.choice(pool, rng.integers(1, 60))) for _ in range(300)])


def test_empty_table(spark):
    assert t.align(spark.createDataFrame([], DDL), *PATHS).collect() == []


def dense(m):
    out = np.zeros((m.height, m.width), np.int64)
    np.add.at(out, (np.repeat(np.arange(m.height), np.diff(m.starts)), m.columns), m.values)
    return out


@pytest.mark.parametrize("step", [1, 7, 1 << 20])
def test_products_equal_dense_ones(step):
    rng = np.random.default_rng(step)
    a = t.counted(rng.integers(0, 9, 40), rng.integers(0, 6, 40), 9, 6)
    b = t.counted(rng.integers(0, 6, 30), rng.integers(0, 11, 30), 6, 11)
    assert (dense(t.product(a, b, step)) == dense(a) @ dense(b)).all()
    assert (dense(a.transposed()) == dense(a).T).all()
    links = t.overlaps(np.array([3, 1, 2]), np.array([1, 2, 2, 1]))
    assert dense(links).tolist() == [[1, 2, 0, 0], [0, 0, 1, 0], [0, 0, 1, 1]]
    assert [x.tolist() if hasattr(x, "tolist") else x for x in t.groups(links)] == [[0, 1, 1], [0, 0, 1, 1], 2]


def test_query(spark):
    from rowsentry.llm.queries import QUERIES

    rows = {r["doc_id"]: r for r in QUERIES["op12_token_alignment"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    for d, w in zip(docs, plain([d["text"] for d in docs])):
        r = rows[d["doc_id"]]
        assert tuple(r[c] for c in t.OUTPUTS[:-1]) == w[:-1]
        assert r["groups_sha256"] == (hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "")


def test_plain_runs_of_both_engines_agree():
    both = t.tokenizers(*PATHS)
    assert both.ranked and both.b_ranked
    rng = np.random.default_rng(5)
    letters = list("aeinrstTHE.,'-09éÀÿß×÷\n\n")
    runs = {" " + "".join(rng.choice(letters, rng.integers(1, 12))) for _ in range(4000)}
    runs = sorted(r.encode() for r in [*runs, " \n", " a\n", " \na", " a\n\nb", " é\né", " a\n×", " hello", " naïve.\nThe", " don't"])
    size = np.array([len(r) for r in runs])
    plain = both._plain(np.frombuffer(b"".join(runs), np.uint8), size).tolist()
    inner = [r[1:].decode() for r in runs]
    assert plain == [not set("×÷") & set(r) and "\n\n" not in r and r == r.strip("\n") for r in inner]
    assert {"naïve.\nThe", "don't", "é\né"} <= {r for r, p in zip(inner, plain) if p}
    a, n_a, b, n_b = both.encode(runs)
    a, b = ([x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] for ids, n in ((a, n_a), (b, n_b)))
    assert a == both._a_each([r.decode() for r in runs]) and b == both._b_each([r.decode() for r in runs])


def test_runs_that_come_again_are_aligned_once(monkeypatch):
    monkeypatch.setattr(t, "REMEMBERED", 30)
    made, whole = Counter(), t.align_runs

    def aligned(runs, *how):
        made.update(runs)
        return whole(runs, *how)

    monkeypatch.setattr(t, "align_runs", aligned)
    memory = t.Known(t.tokenizers(*PATHS))
    for i in range(20):
        column = pa.array([" ".join(["the cat", *(f"x{i}y{k}" for k in range(10)), "sat."])])
        found = t._texts(column, memory)
        plain = t._texts(column, t.Known(memory.both))
        assert [memory.texts[r] for r in found.runs] == [plain.known.texts[r] for r in plain.runs]
        assert (memory.counts[:, found.runs] == plain.known.counts[:, plain.runs]).all()
        assert (memory.pairs[found.links(found.runs)[0]] == plain.known.pairs[plain.links(plain.runs)[0]]).all()
        assert len(memory.number) <= 30 + 13
    assert made[b" cat"] == 20 + 1  # once for all texts, and in each that is compared with
