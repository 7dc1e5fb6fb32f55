"""Exact round trips: token files and formatted conversations."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.orc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from duescope.llm import chat, packing, tokenbin
from duescope.storage import new_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = tokenbin.Encoder(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@given(st.text(alphabet="aZé ñ.,'\n\t 12-<|x", max_size=60) | st.text(max_size=40))
@settings(max_examples=400, deadline=None)
def test_encoder_gives_the_ids_of_the_library(text):
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == library_ids(text)


def test_encoder_forgets_and_learns_again(monkeypatch):
    monkeypatch.setattr(tokenbin, "CACHE", 5)
    encoder, rng = tokenbin.Encoder(PATH), random.Random(1)
    for _ in range(40):
        text = " ".join(rng.choice(["alpha", "beta,", "gamma", "d4", "é", "zeta.", "eta"]) for _ in range(9))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library_ids(text)
        assert len(encoder.words) <= 6


def test_digests_read_back_what_was_written(spark, docs, doc_rows):
    path = new_path(spark, "tokens")
    tokenbin.write(docs, PATH, path)
    got = tokenbin.digests(spark, path).collect()
    want = []
    for r in doc_rows:
        ids = np.array([*library_ids(r[1]), 0], "<u4")
        want.append((r[0], len(ids), zlib.crc32(ids.tobytes())))
    order = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=order) == sorted(want, key=order)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    starts = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: r.start)]
    assert starts == sorted(starts)


def test_files_have_stripes_and_filters_reach_them(spark, docs, tmp_path):
    path = str(tmp_path / "tokens")
    tokenbin.write(docs, PATH, path)
    files = sorted((tmp_path / "tokens").glob("*.orc"))
    assert sum(pyarrow.orc.ORCFile(str(f)).nstripes for f in files) >= 1
    plan = tokenbin.read(spark, path).where("doc_id = 7")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in plan
    assert [r.doc_id for r in tokenbin.read(spark, path).where("doc_id = 7").collect()] == [7]


def test_token_file_of_an_empty_table(spark, empty):
    path = new_path(spark, "tokens")
    tokenbin.write(empty, PATH, path)
    assert tokenbin.digests(spark, path).collect() == []


# --- chat ----------------------------------------------------------------------------------

hard_text = st.text(alphabet="<s>/[INST]\\ \na", max_size=30) | st.text(max_size=20)


@given(hard_text)
@settings(max_examples=400, deadline=None)
def test_escape_is_reversible_and_hides_controls(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROL)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "<s>"]), hard_text), max_size=6))
@settings(max_examples=300, deadline=None)
def test_turns_are_read_back(messages):
    events = list(chat.compiled(chat.TEMPLATE)(iter({"role": r, "text": t} for r, t in messages)))
    text = "".join(e[0] for e in events if e)
    assert list(chat.turns(text)) == messages
    assert chat.unescape("".join(e[0] for e in events if e and e[1])) == "".join(t for r, t in messages if r == "assistant")


def render(template, messages=()):
    return "".join(e[0] for e in chat.compiled(template)(iter(messages)) if e)


def test_template_language():
    assert render("a{# no #}{{ 'b' + 'c' | upper }}{% if not false and 1 == 1 %}d{% else %}e{% endif %}") == "abCd"
    said = [{"role": "x", "text": " Hi "}, {"role": "y", "text": None}]
    loop = "{% for m in messages %}{{ loop.index }}{{ m.text | trim }}{% if loop.first %}!{% elif m.role == 'y' or m.none %}?{% endif %}{% endfor %}"
    assert render(loop, said) == "1Hi!2?"
    assert render("{{ messages.__class__ }}{{ unknown }}{{ 'a\\n' }}") == "a\n"
    assert chat.fold(chat.parse("x{% if 'a' != 'a' %}y{% else %}{{ 'z' }}{% endif %}!")) == chat.Node("text", "xz!")


@pytest.mark.parametrize("bad", ["{% if x %}", "{{ a( }}", "{{ 'a' | call }}", "{% while x %}", "{% for in y %}{% endfor %}", "{{ }}", "{{ a b }}"])
def test_faulty_templates_are_refused(bad):
    with pytest.raises(chat.TemplateError):
        chat.compiled(bad)


def test_conversations_come_back_whole(spark, monkeypatch):
    monkeypatch.setattr(chat, "PIECE", 200)
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), "".join(rng.choice("ab<s>[/INST]\\ é") for _ in range(rng.randint(0, 60))))
            for c in range(20) for t in range(rng.randint(1, 9))]
    rows += [(50, t, "assistant", "x" * 37) for t in range(300)] + [(51, 0, None, None), (None, 1, "user", "a"), (None, 0, "assistant", "b")]
    rows += [(52, 0, "user", "twice"), (52, 0, "user", "twice")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, piece string")
    out = chat.formatted(df)
    assert out.where("conv_id = 50").count() > 10
    got = {r.conv_id: r for r in chat.digests(out).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (
            len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest())
    none = spark.createDataFrame([], df.schema)
    assert chat.digests(chat.formatted(none)).collect() == []


# --- packing -------------------------------------------------------------------------------

@given(st.lists(st.integers(0, 64), max_size=60))
@settings(max_examples=200, deadline=None)
def test_bins_hold_what_is_put_in(lengths):
    places = packing.pack(lengths, (16, 32, 64))
    bins = {}
    for n, (b, start) in zip(lengths, places):
        bins.setdefault(b, []).append((start, n))
    for content in bins.values():
        content.sort()
        assert all(s + n == t for (s, n), (t, _) in zip(content, content[1:])) and content[0][0] == 0
        assert packing.downsized(sum(n for _, n in content), (16, 32, 64)) <= 64


def test_every_token_is_packed_once(spark, docs, doc_rows):
    got = packing.packed(packing.word_tokens(docs), sizes=(64, 256, 1024), shard=20).collect()
    count = lambda t: len((t or "").replace("\x1c", "_").replace(" ", "_").replace(" ", "_").split()) + 1
    want = sorted((r[0] is None, r[0] or 0, count(r[1])) for r in doc_rows)
    parts, bins = {}, {}
    for r in got:
        parts.setdefault((r.doc_id, r.copy if r.doc_id is not None else (r.copy, r.n_tokens)), []).append((r.doc_start, r.n_tokens))
        bins.setdefault((r.shard, r.bin), []).append(r)
    for p in parts.values():
        p.sort()
        assert p[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(p, p[1:]))
    assert sorted((k[0] is None, k[0] or 0, sum(n for _, n in p)) for k, p in parts.items()) == want
    for content in bins.values():
        assert sum(r.n_tokens for r in content) == content[0].bin_used <= content[0].bin_size in (64, 256, 1024)
        assert content[0].bin_size == packing.downsized(content[0].bin_used, (64, 256, 1024))
    assert len({r.shard for r in got}) > 1


def test_packing_takes_odd_counts(spark, empty):
    odd = spark.createDataFrame([(1, None), (1, None), (2, -5), (3, 0), (4, 5000)], "doc_id long, n_tokens long")
    got = packing.packed(odd).collect()
    assert sorted((r.doc_id, r.copy, r.n_tokens) for r in got) == [(1, 0, 0), (1, 1, 0), (2, 0, 0), (3, 0, 0), (4, 0, 904), (4, 0, 4096)]
    assert packing.packed(packing.word_tokens(empty)).collect() == []


def test_filling_up_looks_at_what_is_left():
    left = packing._Left([10, 10, 7, 3])
    assert [left.filled(n) for n in (2, 3, 9, 20, 40)] == [0, 3, 7, 20, 30]
