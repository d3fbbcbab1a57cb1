import pytest

from ledgerlens.llm import html_text as ht
from ledgerlens.llm.html_pages import labelled_pages
from odd_rows import small


@pytest.fixture(scope="module")
def field():
    return ht.train(labelled_pages(800))


def test_blocks():
    page = "<p><b>One&amp;two\n three<br>four<p>fi<i>ve</i> <!-- no --><ul><li>a<li><a href='>'>b</a></ul><script>'</p>'</script>&lt;end"
    assert [b.text for b in ht.blocks(page)] == ["One&two three four", "five", "a", "b", "<end"]
    assert [b.linked for b in ht.blocks(page)] == [0, 0, 0, 1, 0]
    assert ht.blocks("") == [] and [b.text for b in ht.blocks("a < b & c <")] == ["a < b & c <"]


def test_elements_that_are_not_closed():
    texts = lambda page: [b.text for b in ht.blocks(page)]
    for tag in ("svg", "noscript", "select", "object", "math"):
        assert texts(f"<p>one <{tag} a='>'>two</p><p>three</p>") == ["one two", "three"], tag
        assert texts(f"<p>one <{tag.upper()}>two</p><p>three <{tag}>four</{tag}> five</p>")[0] == "one two", tag
    for tag in ("svg", "noscript", "select"):
        assert texts(f"<p>a<{tag}>b<i>c</i></{tag}>d</p><p>e <{tag}>f<p>g <{tag}>h</{tag}> i") == ["ad", "e f", "g i"], tag
        assert texts(f"<p>a<{tag}>b<!-- <{tag}> --><script>'<{tag}>'</script>c</{tag} >d") == ["ad"], tag
    assert texts("<p>a<svg>b<svg>c</svg>d</svg>e<svg/>") == ["ae"]
    for tag in ("script", "style", "textarea", "template", "iframe"):
        assert texts(f"<p>one <{tag}>two</p><p>three</p>") == ["one"], tag
    math = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>TeX</annotation></semantics></math>"
    assert texts(f"<p>Let {math} be.</p><p>See <object data='x'><param name='y'>the text</object> here.") == ["Let x=2 be.", "See the text here."]


def test_names_behind_a_long_list():
    (block,) = ht.blocks(f'<div class="{" ".join(f"mt-{c}" for c in "abcdefghijklmnopqrst")} sidebar">x</div>')
    assert "sidebar" in block.path[0][1] and "named sidebar" in ht.features(block, 0, 1)


def test_labels_fit_the_blocks():
    assert all(len(ht.blocks(p)) == len(y) for p, y in labelled_pages(200))


def test_held_out_pages(field):
    right = total = 0
    for page, labels in labelled_pages(200, seed=7):
        sequence = ht.blocks(page)
        right += (field.decode(field.scores(sequence)) == labels).sum()
        total += len(labels)
    assert right / total > 0.97


def test_viterbi_by_enumeration(field):
    import itertools

    sequence = ht.blocks(labelled_pages(1, seed=3)[0][0])[:9]
    z = field.scores(sequence)

    def score(y):
        return field.ends[0][y[0]] + field.ends[1][y[-1]] + sum(z[i][c] for i, c in enumerate(y)) + sum(field.step[a, b] for a, b in zip(y, y[1:], strict=False))

    assert tuple(field.decode(z)) == max(itertools.product((0, 1), repeat=len(z)), key=score)


def test_pages_of_the_data(spark):
    pages = small(spark, "pages")
    out = {r.page_id: r.text for r in ht.main_texts(pages).collect()}
    for r in pages.collect():
        article = r.html[r.html.index("<article>") : r.html.index("</article>")]
        assert out[r.page_id] == " ".join(b.text for b in ht.blocks(article))


def test_odd_rows(spark):
    rows = [(1, "u", None), (1, "u", ""), (None, None, "<article><p>Text of it, long enough.</p></article>"), (2, "u", "<nav>" * 3000 + "x"), (3, "u", "<p>" + "word " * 50_000), (4, "u", '<a title="')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' as text", "1 as n_chars")
    out = ht.main_texts(pages).toPandas()
    assert len(out) == 6 and out["text"].notna().all() and (out["n_chars"] == out["text"].str.len()).all()
    assert out[out.page_id.isna()]["text"].tolist() == ["Text of it, long enough."]
    assert ht.main_texts(pages.filter("false")).count() == 0
