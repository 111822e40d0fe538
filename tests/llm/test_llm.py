"""Encoding against a library, packing against its limits, statistics against whole texts."""

import json
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelwright.llm import bpe, mail, packing, quality, tokenize, vocabulary
from tests.conftest import rows

FOLDER = os.environ.get("PANELWRIGHT_TOKENIZERS", vocabulary.DEFAULT_FOLDER)
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tokenizer files")
ODD = ["'", "s", "t", "re", "ll", " ", "  ", "\n", "\t", "a", "é", "1", "²", " ", " ", "\x1c", "\x85", "!", "-", "<|endoftext|>", "😀", "ve", "Ⅷ", "中", "́", "\r\n", "'S", "x" * 40, "=" * 70, "d", "m"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(os.path.join(FOLDER, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def ours(texts):
    out = []
    for _, flat, per, _ in bpe.encode_texts(pa.array(texts, type=pa.string()), vocabulary.load(FOLDER)):
        ends = np.cumsum(per)
        out += [flat[a:b].tolist() for a, b in zip(ends - per, ends)]
    return out


def test_encoding_equals_library(library):
    r = random.Random(3)
    texts = ["", "hello world", "it's we'll ''s 's", *("".join(r.choice(ODD) for _ in range(r.randint(0, 30))) for _ in range(4000))]
    assert ours(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abc '\n\t.,19é"), st.characters(max_codepoint=0x2FFF, exclude_categories=("Cs", "Cn"))), max_size=40), max_size=6))
def test_encoding_property(library, texts):
    assert ours(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_long_pieces_and_runs(library, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_BYTES", 500)
    monkeypatch.setattr(bpe, "BATCH_CELLS", 300)
    r = random.Random(1)
    texts = ["".join(r.choice("abcdefgh") for _ in range(n)) for n in (1, 2, 3, 9, 10, 17, 33, 600, 3000)] + [" " * 800, "ab" * 500, "", "x"]
    assert ours(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_encode_query(spark, library):
    texts = [None, "", "  ", "a <|endoftext|> b", "x" * 10_000, "same", "same"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("key", F.lit(2))
    got = dict(rows(tokenize.encode(df, folder=FOLDER)))
    assert got == {i: (library.encode(t, add_special_tokens=False).ids if t else []) for i, t in enumerate(texts)}
    assert 50256 not in got[3]
    assert tokenize.encode(df.where("false"), folder=FOLDER).count() == 0
    decoded = library.decode(got[4])
    assert decoded == texts[4]


def test_sizes_count_head_tokens(spark, library):
    head, body = "Subject: x\nFrom: y\n\n", "body text here"
    df = spark.createDataFrame([(1, head + body), (2, body), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_tokens, r.n_head) for r in tokenize.sizes(df, folder=FOLDER).collect()}
    n = len(library.encode(head + body, add_special_tokens=False).ids)
    assert got[1][0] == n and 0 < got[1][1] < n and got[2][1] == 0 and got[3] == (0, 0)


def test_sizes_know_every_blank_line(spark, library):
    heads = ["Subject: x\r\nFrom: y\r\n\r\n", "Subject: x\nFrom: y\n\r\n", "Subject: x\r\nFrom: y\r\n\r\nAgain\n\n", "Subject: x\nFrom: y\n\nAgain\r\n\r\n"]
    none = ["Subject: x\r\nFrom: y\r\n", "No head\r\n\r\n"]
    df = spark.createDataFrame(list(enumerate(h + "body" for h in heads + none)), "doc_id long, text string")
    got = {r.doc_id: r.n_head for r in tokenize.sizes(df, folder=FOLDER).collect()}
    ends = [len(h) for h in heads[:2]] + [h.index("Again") for h in heads[2:]]
    want = [sum(a < n for a, _ in library.encode(h + "body", add_special_tokens=False).offsets) for h, n in zip(heads, ends)]
    assert [got[i] for i in range(6)] == [*want, 0, 0]


# -- containers -------------------------------------------------------------------------
def fits(tokens, loss, box, limits):
    for b in set(box):
        at = box == b
        if at.sum() > 1:
            assert tokens[at].sum() <= limits.tokens and at.sum() <= limits.segments and loss[at].sum() <= limits.loss_tokens


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(100, 3, 60), packing.Limits(50, 1, 50)])
def test_packing_keeps_limits(limits):
    r = np.random.default_rng(1)
    tokens = r.integers(0, limits.tokens + 1, 700)
    loss = (tokens * r.random(700)).astype(int)
    box = packing.pack_arrays(tokens, loss, limits)
    assert (box >= 0).all()
    fits(tokens, loss, box, limits)


def test_packing_is_tight():
    r = np.random.default_rng(2)
    tokens = np.minimum(2048, r.lognormal(6, 1, 6000).astype(int))
    box = packing.pack_arrays(tokens, tokens, packing.Limits())
    assert box.max() + 1 <= 1.01 * tokens.sum() / 2048 + 1


def test_packing_edges():
    L = packing.Limits(10, 4, 5)
    assert len(packing.pack_arrays(np.zeros(0, int), np.zeros(0, int), L)) == 0
    box = packing.pack_arrays(np.array([0] * 9), np.array([0] * 9), L)
    assert np.bincount(box).tolist() == [4, 4, 1]
    box = packing.pack_arrays(np.array([10, 10, 8]), np.array([9, 2, 8]), L)
    assert sorted(np.bincount(box)) == [1, 1, 1]


def test_pieces_and_pack(spark):
    sizes = spark.createDataFrame([(1, 25, 3, 0), (2, 0, 0, 1), (3, 10, 10, 2), (None, 4, 0, 3), (None, 4, 0, 4)], "doc_id long, n_tokens long, n_head long, deal long")
    L = packing.Limits(10, 8, 10)
    items = packing.pieces(sizes, L)
    assert rows(items.where("doc_id = 1"), "piece", "first_token", "tokens", "loss_tokens") == [(0, 0, 10, 7), (1, 10, 10, 10), (2, 20, 5, 5)]
    out = packing.pack(items, L, 7)
    assert out.count() == 7 and out.where("doc_id = 3").collect()[0].loss_tokens == 0
    per = out.groupBy("container").agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).collect()
    assert all(r.t <= 10 and r.n <= 8 for r in per)
    assert packing.pack(packing.pieces(sizes.where("false"), L), L, 0).count() == 0
    big = sizes.withColumn("doc_id", F.col("doc_id") + 2**60 + 1)
    assert {r.doc_id for r in packing.pack(packing.pieces(big, L), L, 7).collect()} == {2**60 + 2, 2**60 + 3, 2**60 + 4, None}


def test_containers_do_not_depend_on_the_split_of_the_input(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ITEMS", 40)
    r = random.Random(7)
    data = [(i, r.randint(0, 30), 0) for i in range(150)] + [(None, 4, 1)] * 60 + [(7, 3, 0)] * 30
    L = packing.Limits(12, 5, 9)
    seen = []
    for k in (1, 5):
        r.shuffle(data)
        sizes = spark.createDataFrame(data, "doc_id long, n_tokens long, n_head long").repartition(k)
        items = packing.pieces(packing.dealt(sizes), L)
        seen.append(rows(packing.pack(items, L, items.count())))
    assert seen[0] == seen[1] and sum(t[3] for t in seen[0]) == sum(t[1] for t in data)
    assert len({t[5].split("-")[0] for t in seen[0] if t[0] is None}) > 1  # repeats of one row are in many groups


def test_copies_are_opened_in_steps(spark, monkeypatch):
    monkeypatch.setattr(packing, "STEP", 10)
    sizes = spark.createDataFrame([(1, 4, 1)] * 37 + [(2, 4, 1)], "doc_id long, n_tokens long, n_head long")
    got = packing.dealt(sizes)
    assert got.count() == 38 and got.select("deal").distinct().count() == 38


def test_the_loss_limit_binds():
    L = packing.Limits(100, 64, 30)
    tokens, loss = np.array([20] * 8), np.array([15] * 8)
    box = packing.pack_arrays(tokens, loss, L)
    full = [(tokens[box == b].sum(), loss[box == b].sum()) for b in range(box.max() + 1)]
    assert all(t <= 100 and v <= 30 for t, v in full) and any(v == 30 and t < 100 for t, v in full)
    assert box.max() + 1 > packing.pack_arrays(tokens, loss, packing.Limits(100, 64, 100)).max() + 1


# -- quality ----------------------------------------------------------------------------
COMMON = frozenset("the of and to a in is it you that was for on are with as at be this have from we i not".split())
PROSE = "The registrar said that the form was late. We asked the office to send it again, but nobody answered.\nIt is not clear to me why this was so."
MAIL = f"From: A <a@x.example>\nTo: B <b@x.example>\nSubject: s\nMIME-Version: 1.0\nContent-Type: multipart/mixed; boundary=\"=_b\"\n\npreamble\n--=_b\nContent-Type: text/plain; charset=utf-8\n\nHello all,\n\n{PROSE}\n\nKind regards,\nAnn\n555-0100\n\nCONFIDENTIALITY NOTICE: This message is\nfor you.\n\nOn Mon, B wrote:\n> quoted\n| also quoted\n--=_b\nContent-Type: application/pdf; name=\"x\"\nContent-Transfer-Encoding: base64\nContent-Disposition: attachment\n\nAAAA\n--=_b--\n"


def test_own_writing():
    assert mail.own_writing(MAIL) == PROSE
    assert mail.own_writing("Room: 5\nSite: x") == "Room: 5\nSite: x"
    assert mail.own_writing("Received: from a by b; Mon\nHi Ann,\n\nfine") == "fine"
    assert mail.own_writing("a\n-----Original Message-----\nFrom: x\n\nold") == "a"
    assert mail.own_writing("") == "" and mail.own_writing("\n \n") == ""
    qp = "From: a\nContent-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: quoted-printable\n\nf=C3=BCr =\nuns"
    assert mail.own_writing(qp) == "für uns"
    page = "From: a\nContent-Type: text/html\n\n<html><p>x &amp; y</p><table><tr><td>1</td><td>2</td></tr></table></html>"
    assert mail.own_writing(page).split("\n")[:2] == ["x & y", "1\t2"]


def kind_of(spark, text, size=quality.CHUNK_CHARS):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return quality.statistics(quality.merged(quality.pieces(df, COMMON, size=size), COMMON)).collect()[0]


def test_kinds(spark):
    cases = {
        "prose": [PROSE, "Thanks, will do.", PROSE + "\n- one\n- two"],
        "list": ["- blue binders\n- toner x 3\n- charts", "[x] stapler\nTODO coffee\n[ ] keys", "a@x.example\nb@y.example\nc@z.example", "Ann Lee\nBob Ray\nCy Dow", "Room: 5\nSite: keys\nDue: 12", "Here is what you asked for:\n\npens; coffee; room key; charts no. 5;\ntoner; folders for 3; poster"],
        "table": ["| a | b | c |\n| 1 | 2 | 3 |\n| 4 | 5 | 6 |", "a\tb\tc\n1\t2\t3", "year,paid,unit\n2005,1.5,100\n2006,2.5,200", '"a";"b"\n"1";"2"', "year      paid      unit\n2005      1.50      1000"],
        "junk": ["win WIN win!!! WIN win win WIN win!!! win win", "0x1f2e3d4c: mov 3a7d [W+34] ;;28601c\n0x07fbb457: nop aa91", "?{,}$[;$[<(\\@&%)(;[|,|*@}>\\.:,)}\n};&:},&^,,<<%*@|&|:#:%[{>{.&[", "xkqzrtplmwvbnhgfdsjklqwrtzxcvbnmpqrstw\nqwrtzpsdfghjklyxcvbnmqwrtzpsdfghjk", "3c 80 01 24 71 12 51 a6 3b\n0e 53 ec de ec f3 3b 1f 15"],
    }
    for want, texts in cases.items():
        for t in texts:
            assert kind_of(spark, t).kind == want, (want, t)


WORDS = quality.Words(COMMON)


def whole_counts(text):
    return quality.finish(quality.partial(text, WORDS), WORDS)


def bracketed(parts, split):
    """Merges in the order that ``split`` chooses; every state goes through its text form, as between tasks."""
    if len(parts) == 1:
        return json.loads(json.dumps(quality.partial(parts[0], WORDS)))
    k = split(len(parts))
    return json.loads(json.dumps(quality.merge(bracketed(parts[:k], split), bracketed(parts[k:], split), WORDS)))


BITS = ["the ", "registrar ", "x1 ", "said. ", "\n", "\n\n", "a" * 9, "win ", "WIN ", "win", "\t", "  ", " ", "a\tb\tc\n1\t2\t3\nshort\n4\t5\t6\n", "éa", "don't ", "'", "-", ";", ",", "- one\n", "Straße ", "STRASSE ", "0x1f", "!", ":", "\u2003", "\r\n", "99 "]


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(text=st.lists(st.sampled_from(BITS), max_size=60).map("".join), cuts=st.lists(st.integers(0, 400), max_size=12), seed=st.integers(0, 9), line=st.sampled_from([5, 30, 4096]), token=st.sampled_from([3, 8, 256]))
def test_any_cuts_and_bracketing_give_all_counts_of_the_whole(monkeypatch, text, cuts, seed, line, token):
    monkeypatch.setattr(quality, "LINE", line)
    monkeypatch.setattr(quality, "TOKEN", token)
    at = [0, *sorted(min(c, len(text)) for c in cuts), len(text)]
    parts = [text[a:b] for a, b in zip(at, at[1:])]
    r = random.Random(seed)
    state = bracketed(parts, lambda n: r.randint(1, n - 1))
    assert dict(zip(quality.COUNTS, quality.finish(state, WORDS))) == dict(zip(quality.COUNTS, whole_counts(text)))


def test_chunks_are_the_text():
    r = random.Random(4)
    text = "".join(r.choice(BITS) for _ in range(2500)) + "x" * 3000
    for size in (7, 200, 999, 4096):
        parts = quality.chunks(text, size)
        assert "".join(parts) == text and max(map(len, parts)) <= size
        assert quality.finish(bracketed(parts, lambda n: n // 2), WORDS) == whole_counts(text)


def test_state_of_a_chunk_is_bounded():
    for text in ("a" * 10**6, " " * 10**6, "ab " * 300_000, "\n" * 10**5, "- x\n" * 10**5, "a" + " " * 10**6 + "b"):
        assert len(json.dumps(quality.partial(text, WORDS))) < 6 * quality.LINE


def test_filler_and_rows_across_cuts():
    filler = "win WIN win!!! " * 4_800
    assert quality.finish(bracketed(quality.chunks(filler), lambda n: 1), WORDS) == whole_counts(filler)
    rows = "a\tb\tc\n1\t2\t3\nshort\n4\t5\t6\n7\t8\t9"
    for k in range(len(rows)):
        assert quality.finish(bracketed([rows[:k], rows[k:]], lambda n: 1), WORDS) == whole_counts(rows)
    assert whole_counts(rows)[quality.COUNTS.index("list_chars")] == 0


def test_statistics_of_odd_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (4, PROSE), (4, PROSE), (5, PROSE * 400), (None, "x"), (6, PROSE * 30), (6, PROSE * 30), (None, PROSE * 30), (None, PROSE * 30)], "doc_id long, text string").withColumn("kind", F.lit("clash"))
    out = quality.statistics(quality.merged(quality.pieces(df, COMMON, size=1000), COMMON))
    got = out.collect()
    assert len(got) == 11
    once = kind_of(spark, PROSE * 30, 10**9).n_words
    assert sorted(r.n_words for r in got if r.doc_id == 6 or r.doc_id is None) == [1, once, once, once, once]
    by = {r.doc_id: r for r in got}
    assert by[1].kind is None and by[2].n_words == 0 and by[3].mean_word_length is None
    whole = kind_of(spark, PROSE * 400, 10**9)
    assert by[5].n_words == whole.n_words and by[5].n_lines == whole.n_lines and by[5].kind == "prose"
    assert quality.merged(quality.pieces(df.where("false"), COMMON), COMMON).count() == 0
