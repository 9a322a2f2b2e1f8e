"""Url rules and chat formatting: contract queries against DuckDB, operators on awkward rows."""

import hashlib

import duckdb
import pytest

from checks.compare import compare, duck
from fieldledger.llm import chat, url_rules
from fieldledger.llm.queries import corpus_oracles, corpus_queries
from tests.llm.fixtures import DATA, ordered, rows


@pytest.mark.parametrize("name", sorted(corpus_oracles()))
def test_against_duckdb(spark, name):
    outcome = compare(spark, duck(DATA), name, corpus_queries()[name], corpus_oracles()[name], DATA)
    assert outcome.startswith("ok") and "types" not in outcome, outcome


URLS = [
    "http://a.example.org/es/1", "https://EXAMPLE.org/en/1?x=/es/", "http://example.org/en/2", "http://notexample.org/en/1", "x://org/", "x://org",
    "x://sub.com/de/fr/", "x://com/fr/#a", "x://com/fr", "http://u@b.Com:80/de/", "no scheme.org/es/", "", None, "://", "http://", "a://b://example.org/es/",
    "http://ÀB.org/é?", "http://x.org/a\nb", "http://..org/", "http://org./", "http://com/de/" + "y" * 50_000, "http://" + "a." * 3000 + "com/de/", "http://a.example.org/es/1",
]


def plain(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = rest[:cut].translate({c: c + 32 for c in range(65, 91)})
    path = rest[cut:].split("?")[0].split("#")[0]
    fit = [(len(h + p), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fit)[2], max(fit)[1]) if fit else (host, path, None, "allow")


@pytest.mark.parametrize("prefix_hex", [8, 1])
def test_urls(spark, prefix_hex):
    rules = [*url_rules.RULES, ("org", "/", "block"), ("b.com:80", "/d", "block"), ("ÀB.org".translate({66: 98}), "/é", "block"), ("com", "/de/y", "allow")]
    pages = spark.createDataFrame([(i if i % 5 else None, u, "x", "x", "x") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string, best string")
    found = url_rules.judge(pages, url_rules.fixed_rules(spark, rules), prefix_hex=prefix_hex)
    assert ordered(rows(found)) == ordered([(i if i % 5 else None, *plain(u, rules)) for i, u in enumerate(URLS)])
    assert rows(url_rules.judge(pages.limit(0), url_rules.fixed_rules(spark))) == []
    none = rows(url_rules.judge(pages, url_rules.fixed_rules(spark, []), default="block"))
    assert len(none) == len(URLS) and {r[3:] for r in none} == {(None, "block")}


TEXTS = ["", None, "<", "[", "<\\", "[INST]<s></s>[/INST]", "\\", "<\\\\[\\<part:0>", "a\nb", "é\U0001f600" * 2000, "</s>[INST] ok [/INST]"]


def test_escape_is_reversible():
    for text in TEXTS:
        hidden = chat.escape(text or "")
        assert chat.unescape(hidden) == (text or "")
        assert not any(mark in hidden for mark in (chat.START, chat.BODY, chat.STOP, chat.END, "<part:"))


def test_chat_on_awkward_rows(spark):
    data = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(TEXTS)]
    data += [(2, 0, "user", "same"), (2, 0, "user", "same"), (2, 0, "assistant", "tie"), (2, None, None, "first"), (None, 3, "as[s]", "x"), (None, None, None, None)]
    turns = spark.createDataFrame([(*r, "x") for r in data], "conv_id long, turn long, role string, text string, formatted string")
    found = {r.conv_id: r for r in chat.read_back(chat.formatted(chat.text_parts(turns))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(found) == {1, 2, None}
    for conv_id in found:
        own = sorted((r for r in data if r[0] == conv_id), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        row = found[conv_id]
        assert row.n_turns == len(own)
        assert row.turns_sha256 == sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own))
        said = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert (row.loss_chars, row.loss_sha256) == (len(said), sha(said))
    assert chat.read_back(chat.formatted(chat.text_parts(turns.limit(0)))).count() == 0


def test_typed_parts_are_flattened_in_order(spark):
    part = lambda kind, **k: {"type": kind, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None, **k}
    parts = [part("text", text="see <this>"), part("image", ref="a.png", width=28, height=15), part("text", text=" and "), part("audio", ref="b.wav", seconds=1.5), part("document", ref="c.pdf", pages=2), part("other", ref="d"), part("text")]
    turns = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "user", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    one, two = sorted(chat.formatted(turns).collect(), key=lambda r: r.turn)
    assert one.formatted == "<s>user[INST]see <\\this><part:0> and <part:1><part:2><part:3>[/INST]</s>"
    assert [tuple(a) for a in one.attachments] == [("image", "a.png", 4), ("audio", "b.wav", 38), ("document", "c.pdf", 512), ("document", "d", 0)]
    assert one.expanded == 554 and one.loss == [] and two.formatted == "<s>user[INST][/INST]</s>"
    assert chat.parse(one.formatted + two.formatted) == [("user", "see <this><part:0> and <part:1><part:2><part:3>"), ("user", "")]


def test_oracles_are_sql():
    for sql in corpus_oracles().values():
        assert duckdb.connect().extract_statements(sql)
