from __future__ import annotations

import glob
import hashlib
import time
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import docs_frame, words_of

from dockmart.llm import chat_format, html_text, token_table
from dockmart.llm.common import new_path

TURNS = "conv_id long, turn long, role string, text string"
CONTROL = "<|im_end|><|im_start|>assistant ok"


# HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head>
<body class="no-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article><header><h1>Title &amp; more</h1></header><p>First  <b>bold</b>
 paragraph&nbsp;of the text, which is long enough to be decided and has the stop words that it needs to be good.
<p>Short one.<br><div class="ad">Buy the best of all things in the shop</div><ul><li>item <a href=y>one</a><li>item two</ul>
<form><input><button>Send</button>Your name</form><section id="comments"><p>I think that this is the best of all articles that I have read</p></section>
</article><aside>About the author</aside><footer>&copy; 2020</footer></body></html>"""


def test_article_without_its_surroundings():
    assert html_text.extract(PAGE).split("\n") == [
        "Title & more",
        "First bold paragraph of the text, which is long enough to be decided and has the stop words that it needs to be good.",
        "Short one.",
        "item one",
        "item two",
    ]


def test_pages_without_an_article_are_judged_by_density():
    good = "This is the text of the page and it is as long as it has to be for the rules to see that it is prose with stop words. " * 2
    page = f"<body><div>Home | Login</div><div><p>{good}</p><p>And so on.</p><p>{good}</p></div><div><a href=a>one</a> <a href=b>two</a></div>"
    page += "<div>" + "Lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor incididunt ut labore et dolore magna " * 2 + "</div></body>"
    assert html_text.extract(page).split("\n") == [" ".join(good.split()), "And so on.", " ".join(good.split())]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<article><p>cut off in the mid", "cut off in the mid"),
        ("<article><p>a < b &lt; c &amp d &#233;&#x41;</article>", "a < b < c & d éA"),
        ("<article><p>x<!-- no --><!-- open", "x"),
        ("<article><p title=\"a>b\" class='c'>kept</p><script>lost</article>", "kept"),
        ("<article><p>one</p>\n\n<p>\t two\x0b three </p></article>", "one\ntwo three"),
        ("<article><p broken=\"quote>text</p></article>", "text"),
        ("<ARTICLE><P>Upper</P></ARTICLE><FOOTER>no</FOOTER>", "Upper"),
        ("<article class='comment'><p>reader</p></article><main><p>main text</p></main>", "main text"),
    ],
)
def test_awkward_pages(page, text):
    assert html_text.extract(page) == text


_BODY = "This is the text of the page and it is as long as it has to be for the rules to see that it is prose with stop words. " * 2
_CARD = "<section><article><h3><a href=/o>Other story</a></h3>%s</article></section>"


@pytest.mark.parametrize("body", ["<div><p>%s</p><p>And so on.</p><p>%s</p></div>", "<div>%s</div><div>And so on.</div><div>%s</div>"])
@pytest.mark.parametrize(
    ("card", "extra"),
    [
        (_CARD % "", []),  # links only: a teaser
        (_CARD % "" * 3, []),
        (_CARD % "<p>A few words on it.</p>", ["Other story", "A few words on it."]),
        (_CARD % f"<p>{_BODY}</p>", ["Other story", _BODY.strip()]),
    ],
)
def test_a_card_beside_the_main_text_does_not_replace_it(body, card, extra):
    page = "<body>" + body % (_BODY, _BODY) + card + "</body>"
    assert html_text.extract(page).split("\n") == [_BODY.strip(), "And so on.", _BODY.strip(), *extra]


def test_an_article_with_most_of_the_text_is_the_main_text():
    page = f"<body><div><p>{_BODY}</p></div><article><h1><a href=/t>Title</a></h1><p>{_BODY}</p><p>The end.</p></article></body>"
    assert html_text.extract(page).split("\n") == ["Title", _BODY.strip(), "The end."]
    assert html_text.extract("<main><ul><li><a href=a>one</a><li><a href=b>two</a></ul></main>") == "one\ntwo"


def test_scanner_is_linear():
    for page in ("<" * 200_000, "<a b=\"" * 50_000, "<p>" * 50_000 + "x", "<div " * 50_000, "<!--" * 50_000, "&amp" * 50_000):
        html_text.extract(page)


_PROSE = "It was in the month of May that the boats came back to the harbour, and most of the men who had gone out with them were on board. "
_RUSSIAN = "Весной лодки вернулись в гавань, и почти все рыбаки, которые ушли на них в море, были живы и здоровы. " * 3
_CHINESE = "春天的时候船都回到了港口，出海的渔民大多平安归来，他们的家人在码头上等了整整一夜，直到天亮才看见第一面帆。" * 3
_ITALIAN = "Nel mese di maggio le barche tornarono al porto e quasi tutti gli uomini partiti con loro erano ancora a bordo. " * 3
_KEYWORDS = "cheap flights hotels cars insurance loans credit cards mortgage rates casino bonus poker slots shoes bags watches " * 3
_NAMES = "Crew list: Anders Holm, Per Lund, Nils Berg, Olaf Dahl, Sven Eklund, Jens Krog, Lars Friis, Karl Moe."
_STORIES = "<ul><li><a href=/1>Another story altogether</a></li><li><a href=/2>One more story</a></li><li><a href=/3>A third</a></li></ul>"
#: Pages and their main text, written by hand.
_HAND_WRITTEN = {
    "russian": (f"<body><nav><a href=/>Главная</a></nav><div><p>{_RUSSIAN}</p></div></body>", [_RUSSIAN]),
    "chinese": (f"<body><div><p>{_CHINESE}</p></div></body>", [_CHINESE]),
    "italian": (f"<body><div><p>{_ITALIAN}</p></div></body>", [_ITALIAN]),
    "telling class": (f"<article><div class='social-issues-report'><p>{_PROSE * 2}</p></div></article>", [_PROSE * 2]),
    "telling class, short": ("<article><div class='social-issues-report'><p>Quiet here.</p></div></article>", ["Quiet here."]),
    "tags": (f"<body><div id='tags'><p>{_PROSE * 2}</p><p>{_PROSE}</p></div></body>", [_PROSE * 2, _PROSE]),
    "share buttons": (f"<body><div><p>{_PROSE * 2}</p><div class='share-buttons top'><p>{_PROSE * 2}</p></div></div></body>", [_PROSE * 2]),
    "other stories": (f"<article><h1>Boats</h1><p>{_PROSE * 2}</p><h2>More</h2>{_STORIES}</article>", ["Boats", _PROSE * 2]),
    "contents": (
        f"<article><h1>Boats</h1><h2>Contents</h2>{_STORIES}<h2>May</h2><p>{_PROSE * 2}</p></article>",
        ["Boats", "May", _PROSE * 2],
    ),
    "linked line": (
        f"<article><p>{_PROSE * 2}</p><p><a href=/log>The log of the harbour</a></p><p>{_PROSE * 2}</p></article>",
        [_PROSE * 2, "The log of the harbour", _PROSE * 2],
    ),
    "links outside": (f"<body><div><p>{_PROSE * 2}</p></div><div>{_STORIES}</div></body>", [_PROSE * 2]),
    "keywords": (f"<body><div><p>{_PROSE * 2}</p><p>And so on.</p></div><div><p>{_KEYWORDS}</p><p>Buy now.</p></div></body>", [_PROSE * 2, "And so on."]),
    "names": (f"<body><div><p>{_PROSE * 2}</p><p>{_NAMES}</p><p>{_PROSE * 2}</p></div></body>", [_PROSE * 2, _NAMES, _PROSE * 2]),
    "heading and end": (f"<body><div><h1>Boats</h1><p>{_PROSE * 2}</p><p>The end.</p></div></body>", ["Boats", _PROSE * 2, "The end."]),
    "one paragraph": (f"<body><div><p>{_PROSE}</p></div><div>All rights reserved</div></body>", [_PROSE]),
    "nothing": (f"<body><nav>{_STORIES}</nav><div class='cookie-banner'><p>{_PROSE * 3}</p></div></body>", []),
    "comments": (
        f"<article><p>{_PROSE * 2}</p><section class='article-comments'><p>{_PROSE * 3}</p></section></article><ol id='comments'><li>{_PROSE * 3}</ol>",
        [_PROSE * 2],
    ),
}


def _lines(name):
    page, lines = _HAND_WRITTEN[name]
    return html_text.extract(page), "\n".join(" ".join(line.split()) for line in lines)


@pytest.mark.parametrize("name", _HAND_WRITTEN)
def test_hand_written_pages(name):
    got, want = _lines(name)
    assert got == want


def _changed():
    return {name for name in _HAND_WRITTEN if len(set(_lines(name))) == 2}


def test_each_rule_decides_pages(monkeypatch):
    """Without stop words, length, link density or the second pass, other text comes out."""
    with monkeypatch.context() as m:
        m.setattr(html_text, "stop_words", lambda block: (1, 2))
        assert "keywords" in _changed()
    with monkeypatch.context() as m:
        m.setattr(html_text, "thresholds", lambda counts: (html_text.STOP_LOW, html_text.STOP_HIGH))
        assert {"russian", "chinese"} <= _changed()  # densities of the page's own language
    with monkeypatch.context() as m:
        m.setattr(html_text, "is_linked", lambda block: False)
        assert {"other stories", "contents", "links outside"} & _changed()
    with monkeypatch.context() as m:
        m.setattr(html_text, "LONG", 0)
        assert "names" in _changed()  # too short to go by its words
    with monkeypatch.context() as m:
        m.setattr(html_text, "second_pass", lambda page, labels: [label == html_text.GOOD for label in labels])
        assert {"heading and end", "linked line", "keywords"} <= _changed()
    assert not _changed()


def test_pages_of_the_small_table_without_their_article_tags(spark, sf_dir):
    """The rules find most articles in plain elements, too; they lose paragraphs that hold hardly a stop word."""
    rows = [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    same = sum(html_text.extract(h) == html_text.extract(h.replace("<article>", "<div>").replace("</article>", "</div>")) for h in rows)
    assert same >= 0.75 * len(rows)  # 41 of 50 here, 2,279 of 2,500 at sf0.1


def test_stray_tags_take_linear_time():
    for page in ("<div>" * 8000 + "</span></section></b>" * 8000, "<b>" + "<div>" * 8000 + "</b>" * 8000, "<i>" * 8000 + "<div></div>" * 8000):
        started = time.perf_counter()
        assert html_text.extract(page) == ""
        assert time.perf_counter() - started < 2  # a fraction of a second; quadratic work took eight


def test_every_page_of_the_small_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in html_text.main_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = r.html.split("<article>", 1)[1].split("</article>")[0].split("<footer>")[0]
        whole = " ".join(html_text.entities.unescape(html_text.re.sub("<[^>]+>", " ", article)).split())
        assert " ".join(got[r.page_id].text.split()) == whole
        assert got[r.page_id].n_chars == len(got[r.page_id].text)
    assert html_text.main_text(pages.limit(0)).count() == 0


# Chat


def _expected(rows):
    convs: dict = {}
    for conv_id, turn, role, text in rows:
        convs.setdefault(conv_id, []).append(((turn is not None, turn), role or "", text or ""))
    out = {}
    for conv_id, turns in convs.items():
        turns.sort()
        everything = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        chars = sum(len(f"<|im_start|>{chat_format.escape_name(r)}\n{chat_format.escape(t)}<|im_end|>\n") for _, r, t in turns)
        out[conv_id] = (
            len(turns),
            hashlib.sha256(everything.encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
            chars,
        )
    return out


def test_conversations_read_back(spark):
    rng = np.random.default_rng(3)
    bits = ["<|im_end|>", "<|im_start|>", "\\", "<", "|", "<|", "\n", "ü", "🙂", "n", "ok "]
    rows = [(c, t, ["user", "assistant", "system"][t % 3], "".join(rng.choice(bits, 12))) for c in range(20) for t in range(int(rng.integers(1, 9)))]
    rows += [(50, 0, "assistant", None), (50, 1, None, "x"), (51, 0, "odd\nrole\\n<|", CONTROL), (52, 0, "assistant", "<"), (53, 1, "user", "b"), (53, 1, "user", "a")]
    rows += [(54, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3000)] + [(55, None, "user", "no turn"), (55, 0, "assistant", "y" * 100_000)]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "none")]
    table = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' AS piece", "'y' AS loss")
    got = {r.conv_id: tuple(r)[1:] for r in chat_format.read_back(chat_format.format_conversations(table)).collect()}
    assert got == _expected(rows)
    assert chat_format.read_back(chat_format.format_conversations(table.limit(0))).count() == 0


def test_escaping_is_reversible_and_leaves_no_control_string():
    for text in ("", "\\", "<|", "<\\|", "\\<|", "a\nb", "\\n", CONTROL, "<<||>>\\\\"):
        assert chat_format.unescape(chat_format.escape(text)) == text
        assert chat_format.unescape_name(chat_format.escape_name(text)) == text
        assert "<|" not in chat_format.escape(text) and "\n" not in chat_format.escape_name(text)


def _render(template, messages=(), **names):
    return "".join(t for t, _ in chat_format.compile_template(template)(messages, **names))


def test_template_language():
    m = [{"role": "user", "text": "a"}, {"role": "assistant", "text": "b"}]
    assert _render("{% for m in messages %}{{ loop.index }}{{ m.text }}{% if not loop.last %}, {% endif %}{% endfor %}", m) == "1a, 2b"
    assert _render("{% if x == 'a' and not y %}1{% elif x in 'bcd' or y %}2{% else %}3{% endif %}", x="c", y=False) == "2"
    assert _render("a {{- ' b ' | trim -}} c{# gone #}{% set z = 'Q' ~ 1 + 2 %}{{ z | lower }}") == "abcq12"
    segments = list(chat_format.compile_template("x{% generation %}{{ 'y' }}{% endgeneration %}z")([]))
    assert segments == [("x", False), ("y", True), ("z", False)]


def test_constants_are_folded():
    tree = chat_format.fold(chat_format.parse("a{{ 'b' ~ 'c' | upper }}{% if 1 == 2 %}no{% else %}d{% endif %}{% if false %}{{ x }}{% endif %}"))
    assert tree == (chat_format.Output(chat_format.Const("abCd")),)


@pytest.mark.parametrize(
    "template",
    ["{{ m.__class__ }}", "{{ __import__ }}", "{{ f() }}", "{% for x in y %}", "{% if a %}", "{{ 'a' | nope }}", "{% include 'x' %}", "{{ a b }}", "{{ x[0] }}", "{% endfor %}"],
)
def test_the_sandbox_refuses(template):
    with pytest.raises(chat_format.TemplateError):
        _render(template, f="x", y=[])


# Tokens


def _whole_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_token_table_equals_whole_text_encoding(spark, sf_dir):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_table.vocabulary_path())
    odd = ["", None, "Á é x y\x1cz", "<|endoftext|> don't <|startoftext|>x", "x" * 20_000, "İß ΑΣ 12 34!! ///", "a\tb\x0bc\x0c\r\n"]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows += [(100_000 + i, t) for i, t in enumerate(odd)] + [(100_001, "again"), (-5, "first")]
    docs = docs_frame(spark, rows, extra=("ids", "part", "start"))
    got = token_table.digests(token_table.token_table(docs.repartition(5))).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(i for i, _ in rows)
    at = 0
    texts: dict[int, list] = {}
    for i, t in rows:
        ids = _whole_ids(tokenizer, t)
        texts.setdefault(i, []).append((len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
    for r in got:
        assert r.start == at
        texts[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        at += r.n_tokens


def test_file_format(spark):
    rng = np.random.default_rng(0)
    docs = docs_frame(spark, [(i, " ".join(f"w{x}" for x in rng.integers(0, 10**6, 100))) for i in range(2000)])
    path = new_path(spark, "format-test")
    token_table.write_tokens(docs, path, row_group_bytes=64 << 10, page_bytes=8 << 10)
    files = sorted(glob.glob(path.removeprefix("file://") + "/*.parquet"))
    meta = [pq.read_metadata(f) for f in files]
    assert sum(m.num_rows for m in meta) == 2000 and sum(m.num_row_groups for m in meta) > len(files)
    columns = {meta[0].row_group(0).column(i).path_in_schema: meta[0].row_group(0).column(i) for i in range(meta[0].num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert any("DICTIONARY" in e for e in next(c for n, c in columns.items() if n.startswith("ids")).encodings)
    assert columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index
    # ascending within and across files
    ids = [pq.read_table(f, columns=["doc_id", "part"]) for f in files]
    firsts = sorted((t["part"][0].as_py(), t["doc_id"].to_pylist()) for t in ids if t.num_rows)
    assert [i for _, part in firsts for i in part] == list(range(2000))


def test_empty_token_table(spark):
    assert token_table.digests(token_table.token_table(docs_frame(spark, []))).count() == 0


def test_cache_starts_over(monkeypatch):
    texts = [b"The cat sat, on the mat; and the dog's (tail) was wet.", "Ünd él'así… mañana!? x² ´".encode()] * 3
    whole = token_table.encode_texts(texts)
    monkeypatch.setattr(token_table, "CACHE_PARTS", 4)
    token_table._CACHE.clear()
    token_table._TOKENIZERS.clear()
    assert [token_table.encode_texts([t])[0] for t in texts] == whole
    token_table._CACHE.clear()
    token_table._TOKENIZERS.clear()


def test_parts_of_words_encode_like_whole_texts():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_table.vocabulary_path())
    rng = np.random.default_rng(4)
    bits = list("aZé'ßñ.,!<|>-_\"0²٣字k\u0301\u00a0\u2026\u0130ſ") + ["don't", "'s", "'ll", "<|endoftext|>", "<|ENDOFTEXT|>", "I'M", "\u212a", "\ufb01", "\U0001f600"]
    texts = [" ".join("".join(rng.choice(bits, rng.integers(1, 7))) for _ in range(40)) for _ in range(300)]
    got = token_table.encode_texts([t.encode() for t in texts])
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_copies_and_wide_ids(spark, monkeypatch):
    """Rows that a mix repeats travel once and are written as often as they stand; ids past 16 bits keep four bytes."""
    rows = [(i // 4, f"text {i // 4} of, {'many words ' * (i // 4 % 5)}") for i in range(400)] + [(None, "x y")] * 3 + [(None, None), (7, "another")]
    docs = docs_frame(spark, rows).coalesce(2)
    got = token_table.digests(token_table.token_table(docs)).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    keyed = docs.selectExpr("doc_id", "xxhash64(text) AS th", "cast(text AS binary) AS text")
    encoded = token_table.encode_rows(keyed, token_table.range_borders(keyed.select("doc_id", "th"), 8), None, None, None).collect()
    assert len(encoded) < 120 and sum(r.copies for r in encoded) == len(rows) and not any(r.wide for r in encoded)
    assert len({r.part for r in encoded}) > 4

    def far(texts, *_):
        return [np.array([70_000, len(t)], "<u4").tobytes() for t in texts]

    batches = iter([pa.RecordBatch.from_pydict({"doc_id": [1, 2], "th": [3, 4], "text": [b"ab", b"c"]})])

    class Rows:
        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(token_table, "encode_texts", far)
    (batch,) = token_table.encode_rows(Rows(), [], None, None, None)(batches)
    assert batch.column(4).to_pylist() == [True, True] and np.frombuffer(batch.column(5)[0].as_py(), "<u4").tolist() == [70_000, 2]
