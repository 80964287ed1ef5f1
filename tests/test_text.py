"""Text operators against hand-made rows (FIXTURES.md section 3) and brute force."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reference_impl import clean, short_name
from wordlens.functions import text as T

CASES = [
    # input, kept (drop_empty=True), compat (drop_empty=False)
    ("Hello, World!  don't (stop).", ["hello", "world", "don", "t", "stop"],
     ["hello", "world", "don", "t", "stop"]),
    ("!lead", ["lead"], ["", "lead"]),
    ("", [], [""]),
    ("   ", [], [""]),
    ("the and", [], [""]),
    ("!the", [], [""]),
    ("a–b’s café", ["a–b’s", "café"], ["a–b’s", "café"]),
    ("A & B", ["b"], ["b"]),
]


def _words(spark, texts, drop_empty):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    rows = df.select("id", T.clean_words("text", drop_empty=drop_empty).alias("w")).collect()
    return {r.id: list(r.w) for r in rows}


def test_fixture_rows_kept_and_compat(spark):
    texts = [c[0] for c in CASES]
    kept = _words(spark, texts, True)
    compat = _words(spark, texts, False)
    for i, (text, want_kept, want_compat) in enumerate(CASES):
        assert kept[i] == want_kept, text
        assert compat[i] == want_compat, text


def test_brute_force_matches_fixture_rows():
    for text, want_kept, want_compat in CASES:
        assert clean(text) == want_kept
        assert clean(text, drop_empty=False) == want_compat


def test_cleaned_text_joins_with_spaces(spark):
    df = spark.createDataFrame([("Hello, the World!",)], "text string")
    assert df.select(T.cleaned_text("text")).first()[0] == "hello world"


def test_remove_stop_words_keeps_duplicates_and_order(spark):
    df = spark.createDataFrame([(["b", "the", "a", "b", "c", "b"],)], "w array<string>")
    assert df.select(T.remove_stop_words("w")).first()[0] == ["b", "b", "c", "b"]


def test_url_short_name(spark):
    urls = ["http://a.com/b/c", "http://a.com/b/c/", "https://m.ththth.example.net/en/25#top"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [r[0] for r in df.select(T.url_short_name("url")).collect()]
    assert got == ["c", "c", "25#top"] == [short_name(u) for u in urls]


def test_comma_list():
    assert T.comma_list("the, is ,,a") == ["the", "is", "a"]


PAGE = (
    "<html><head><style>p{x:1}</style><script>var t=\"</p>\";</script></head><body>"
    "<!-- <article><p>hidden</p></article> -->"
    "<nav><p>menu</p></nav><article><h1>T</h1><p class='x'><b>Big &amp; bold</b> "
    "text &lt;ok&gt;<br>next<p>second</p></article></body></html>"
)


def test_page_description_first_paragraph(spark):
    df = spark.createDataFrame([(PAGE,), ("<html><p>no article</p></html>",)], "html string")
    got = [r[0] for r in df.select(T.page_description("html")).collect()]
    assert got == ["Big & bold text <ok> next", None]


ascii_text = st.text(alphabet=st.sampled_from(list("abcXYZ éñ’–.,!?'&-_ \t\n")), max_size=40)


@settings(max_examples=5, deadline=None)
@given(st.lists(ascii_text, min_size=1, max_size=60))
def test_tokenizer_matches_brute_force(spark, texts):
    kept = _words(spark, texts, True)
    compat = _words(spark, texts, False)
    for i, text in enumerate(texts):
        assert kept[i] == clean(text), repr(text)
        assert compat[i] == clean(text, drop_empty=False), repr(text)


PAGES = [
    # page, description by the rule: the first paragraph within the container, ended by any block-level tag
    ("<article><h1>T</h1></article><footer><p>Footer text</p></footer>", None),
    ("<article><p>H<sub>2</sub>O un<b>believ</b>able</p></article>", "H2O unbelievable"),
    ("<article><p>caf&eacute; it&rsquo;s &#8211; &apos;q&apos; &#x1F600;</article>", "café it’s – 'q' 😀"),
    ("<article><p>one<ul><li>two</li></ul></article>", "one"),
    ("<article><p></p><p>real</p></article>", ""),
    ("<article><p>a<br>b<BR/>c\n  d&nbsp;e</p></article>", "a b c d e"),
    ("<article><p>&amp;lt; &#38;amp; &bogus; a&b &#0; 1 < 2</p></article>", "&lt; &amp; &bogus; a&b &#0; 1 < 2"),
    ("<!-- <article><p>no</p></article> --><article><script>'<p>x</p>'</script><p class='k'>yes</p></article>", "yes"),
    ("<p>out</p><article><pre>x</pre></article>", None),
    ("<articles><p>no</p></articles>", None),
    ("<article><div><article>inner</article></div><p>after</p></article>", "after"),
    ("<article><article><p>deep</p></article><p>later</p></article><p>out</p>", "deep"),
    ("<ARTICLE><article><article></article></ARTICLE></article><p>out</p>", None),
    ("<article><articles></articles></article x><p>out</p>", None),
    ("<article><article></article><p>never closed", "never closed"),
    ("<article><p>1</p></article><article><p>2</p></article>", "1"),
    ("", None),
    (None, None),
]


def test_page_description_of_hand_made_pages(spark):
    df = spark.createDataFrame([(str(i), h) for i, (h, _) in enumerate(PAGES)], "url string, html string")
    got = {r.url: r.d for r in df.select("url", T.page_description("html").alias("d")).collect()}
    assert got == {str(i): want for i, (_, want) in enumerate(PAGES)}
    valid = {r.url: r.description for r in T.described_pages(df).collect()}
    assert valid == {str(i): want for i, (_, want) in enumerate(PAGES) if want is not None}


def test_container_by_id(spark):
    pages = ["<p>no</p><div class=x id='productDescription'><p>yes</p></div>", "<div id=productDescription2><p>no</p></div>",
             "<section id=\"productDescription\"></section><p>no</p>",
             "<div id=\"productDescription\"><div>box</div><p>real text</p></div>",
             "<div id=productDescription><div><div></div><DIV>a</DIV></div></div><p>no</p>",
             "<div id=productDescription><div><p>in</p></div></div>", "<img id=productDescription><p>no</p>",
             "<my-box id=productDescription><my-box></my-box><p>own</p></my-box>"]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    assert [r[0] for r in df.select(T.page_description("html", T.element_by_id("productDescription"))).collect()] == [
        "yes", None, None, "real text", None, "in", None, "own"]


def test_nested_pages_in_the_oracle(spark):
    """The oracle finds the container's end in another way; both read the hand-made pages alike."""
    import duckdb

    from wordlens.plans.sql import page_description
    nested = [h for h, _ in PAGES if h and "bogus" not in h and "&eacute" not in h]
    con = duckdb.connect()
    got = [con.execute(f"SELECT {page_description('h')} FROM (SELECT ? AS h)", [h]).fetchone()[0] for h in nested]
    assert got == [want for h, want in PAGES if h in nested]


def test_comma_list():
    assert T.comma_list(" a, b,,c ,") == ["a", "b", "c"] and T.comma_list("") == []
