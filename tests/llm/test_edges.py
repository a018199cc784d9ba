"""Awkward columns, repeated page ids, long texts through Spark, and pages whose parts have odd names."""

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import exact_dedup, html_text, jaccard, language, licenses, packing, toxicity


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def awkward(docs):
    """Columns with a dot, a blank and a back quote in their names, clashing ones, and the text under another case."""
    return docs.withColumnRenamed("text", "Text").withColumns({c: F.lit("x") for c in ("_drawn", "a.b", "c d", "c0", "sha_", "place_", "row_", "gone_", "_gone", "y0", "n")}).withColumn("e`f", F.lit("y"))


def rows(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()))


def test_stages_take_any_column_names(spark, sf_dir, docs, awkward):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    network, chain = language.train(docs, steps=5), toxicity.train(docs, labels)
    assert language.train(awkward, steps=5).languages == network.languages
    for stage in (exact_dedup.drop_exact_copies, lambda d: toxicity.reject_toxic(d, chain), lambda d: language.keep_identified(d, network, 0.3), jaccard.drop_near_copies):
        plain, odd = stage(docs), stage(awkward)
        assert odd.columns == awkward.columns and rows(odd) == rows(plain)
        assert odd.where("`a.b` = 'x' AND `e``f` = 'y'").count() == plain.count()


def test_no_table_stays_in_the_catalog(spark, docs):
    before = {t.name for t in spark.catalog.listTables()}
    assert exact_dedup.exact_groups(docs).count() == docs.count()
    exact_dedup.drop_exact_copies(docs).count()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_long_texts_and_repeated_pages(spark, sf_dir, docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    text = docs.where("lang = 'en'").orderBy("doc_id").first()["text"]
    long = spark.createDataFrame([(1, text * 400), (2, text)], "doc_id long, text string")
    chain, network = toxicity.train(docs, labels), language.train(docs)
    p = {r["doc_id"]: r["p_toxic"] for r in toxicity.score(long, chain).collect()}
    assert abs(p[1] - p[2]) < 0.5
    assert {r["lang_pred"] for r in language.identify(long, network).collect()} == {"en"}
    words = {r["doc_id"]: r["n_words"] for r in licenses.scan(long).collect()}
    assert words[1] >= 399 * words[2]
    weights = html_text.learn_weights(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    page = "<html><body><nav><a href=x>menu</a></nav><article>" + "<p>some words of the article here</p>" * 20_000 + "</article></body></html>"
    pages = spark.createDataFrame([(7, "u", page), (7, "u", "<p>other words that are long enough</p>"), (7, "u", page)], "page_id long, url string, html string")
    got = sorted(len(r["text"].split("\n")) for r in html_text.extract_pages(pages, weights).collect())
    assert got == [1, 20_000, 20_000]


@pytest.fixture(scope="module")
def weights(spark, sf_dir):
    return html_text.learn_weights(spark.read.parquet(f"{sf_dir}/pages.parquet"))


MENU = '<div class="q1"><ul><li><a href="/a">Home</a></li><li><a href="/b">About</a></li></ul></div>'


def page(article, around=MENU):
    return f"<!DOCTYPE html><html><head><title>t</title></head><body>{around}{article}<footer>Imprint and contact</footer></body></html>"


TEXT = "<p>The first paragraph of the text is here, with quite a few words.</p><p>The second one follows, and it has words, too.</p>"
LINES = ["The first paragraph of the text is here, with quite a few words.", "The second one follows, and it has words, too."]


@pytest.mark.parametrize(
    ("article", "want"),
    [
        (f"<article>{TEXT}<ul><li>milk</li><li>eggs</li></ul></article>", [*LINES, "milk", "eggs"]),
        (f"<article><ul><li>milk</li></ul>{TEXT}</article>", ["milk", *LINES]),
        (f"<article>{TEXT}<p><a href=1>one</a> <a href=2>two</a> <a href=3>three</a></p></article>", [*LINES, "one two three"]),
        (f"<article><header><h1>Title</h1></header>{TEXT}</article>", ["Title", *LINES]),
        (f'<article><header class="post-header"><h1>Title</h1></header>{TEXT}</article>', ["Title", *LINES]),
        (f"<main><h1>Title</h1>{TEXT}<table><tr><td>cell</td><td>two</td></tr></table></main>", ["Title", *LINES, "cell", "two"]),
        (f'<article class="k8 zz">{TEXT}<div class="p0q"><p>More words.</p></div></article>', [*LINES, "More words."]),
        (f'<article class="no-comments has-ads">{TEXT}<div class="no-sidebar"><p>More words.</p></div></article>', [*LINES, "More words."]),
    ],
)
def test_articles_keep_their_lists_links_and_titles(weights, article, want):
    assert html_text.extract(page(article), weights).split("\n") == want


@pytest.mark.parametrize(
    "name", "reader-comments user-comments commentlist comments-area replies respond sponsored-content cookie-consent adsbygoogle google-ads related-articles newsletter-signup social-links promo_box advertisement-slot breadcrumbs".split()
)
def test_comments_adverts_and_notices_go(weights, name):
    for spot in (f'{TEXT}<div class="{name}"><p>Six words that must go away.</p></div>', f'<p>{LINES[0]}</p><section id="{name}">Six words that must go away.</section><p>{LINES[1]}</p>'):
        assert html_text.extract(page(f"<article>{spot}</article>"), weights).split("\n") == LINES


def test_scores_equal_plain_ones(weights):
    """A token's score from its own element, tag and place, computed without the tokens' flags."""
    text = page(f"<main><article>{TEXT}<ul><li>milk</li></ul><div class=ads>no</div></article><p>after it</p></main>")
    found = html_text.tokens(text, weights.containers)
    depth, outside, got = [], [], html_text.scores(found, weights)
    for t, score in zip(found, got):
        closing = t.feature.startswith("tag:/")
        name = t.feature.removeprefix("tag:").removeprefix("/")
        if t.feature.startswith("tag:") and closing and name in depth:
            while depth.pop() != name:
                outside.pop()
            outside.pop()
        elif t.feature.startswith("tag:") and not closing and name not in html_text.VOID:
            depth.append(name)
            outside.append(name in ("nav", "footer", "head", "title") or name == "div" and "no" in text and "article" in depth)
        if any(outside):
            assert score == 0.0
        elif "article" in depth and t.words:
            assert score == max(weights.by.get(t.feature, 0.5) * t.words, html_text.LEAST_GAIN * t.words)
        elif t.words:
            assert score == weights.by.get(t.feature, 0.5) * t.words


def test_packing_of_no_and_long_texts(spark):
    import public_tokenizers

    df = spark.createDataFrame([(1, "word " * 30_000), (2, None)], "doc_id long, text string").withColumn("a.b", F.lit(1))
    got = packing.pack_documents(df, public_tokenizers.path(packing.VOCABULARY)).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert all(r["n"] == r["all"] for r in got) and {r["doc_id"] for r in got} == {1, 2}
