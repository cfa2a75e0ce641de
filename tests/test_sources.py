import json
import random

import pytest
from pyspark.sql import functions as F

from lexspark.functions import text
from lexspark.sources import articles, examples, features, lines

TWO = (
    '<doc id="1" url="u1" title="Foo Bar">\nFoo Bar\n\n  First sentence here. Second one!\n</doc>\n'
    '<doc id="2" url="u2" title="Q &amp; A">\nBody two.\n</doc>\n'
)
EXPECTED = [("Foo Bar", "Foo Bar  First sentence here. Second one!"), ("Q &amp; A", "Body two.")]


def write(folder, name, content):
    path = folder / name
    path.write_text(content, encoding="utf-8")
    return str(path)


def read(spark, path, **options):
    return [
        (r["title"], r["article"])
        for r in articles.read_articles(spark, path, **options).orderBy("file", "ord").collect()
    ]


@pytest.mark.parametrize("splittable", [False, True])
def test_articles(spark, tmp_path, splittable):
    path = write(tmp_path, "wiki_00", TWO)
    assert read(spark, path, splittable=splittable) == EXPECTED


@pytest.mark.parametrize("splittable", [False, True])
def test_first_article_only(spark, tmp_path, splittable):
    path = write(tmp_path, "wiki_00", TWO)
    assert read(spark, path, first_only=True, splittable=splittable) == EXPECTED[:1]


@pytest.mark.parametrize(
    ("content", "expected"),
    [
        ('<doc id="1" title="A">\nx\n<doc id="2" title="B">\ny\n</doc>\n', [("B", "y")]),
        ('<doc id="1">\nx\n</doc>\n', [(None, "x")]),
        ('<doc id="1" title="A" title="B">\nx\n</doc>', [("B", "x")]),
        ('<doc title="A">\nsee </doc> here\n</doc>\n', [("A", "see </doc> here")]),
        ('<doc title="A">\nx\n</doc>\nlost\n<doc title="B">\ny\n</doc>\n', [("A", "x"), ("B", "y")]),
        ('<doc title="A">\nx\n</doc>\n<doc title="B">\nopen', [("A", "x")]),
        ('<doc title="A">\n</doc>\n', [("A", "")]),
        ('  <doc title="A">\n x　\n  </doc>\n', [("A", "x")]),
    ],
)
def test_article_edges(spark, tmp_path, content, expected):
    assert read(spark, write(tmp_path, "f", content)) == expected


@pytest.mark.parametrize("splittable", [False, True])
def test_blank_line_before_the_closing_line(spark, tmp_path, splittable):
    path = write(tmp_path, "f", '<doc title="A">\nx\n\n</doc>\n<doc title="B">\n\n</doc>\n')
    assert read(spark, path, splittable=splittable) == [("A", "x "), ("B", "")]


def test_nothing_is_cut_without_a_limit(spark, tmp_path):
    listed = write(tmp_path, "list", "".join(f"f{i}\n" for i in range(60)))
    assert lines.read_manifest(spark, listed).count() == 60
    weights = write(tmp_path, "weights", "A 1\nB 3\nA 2\n")
    assert {tuple(r) for r in lines.first_titles(spark, weights).collect()} == {("A", 2), ("B", 3)}
    assert lines.top_titles(lines.read_title_weights(spark, weights)).count() == 2


EDGES = [
    '<doc title="A">\nx\n</doc>\n<doc title="B">\nopen', '<doc title="A">\nx\n</doc>\n<doc title="B">\nopen\n  \n',
    '<doc title="A">\nonly\n\nopen\n\n', '<doc title="A">\nx\n</doc> <doc title="B">\ny\n</doc>',
    '<doc title="A">\na </doc> b </doc>\nc</doc></doc>\n </doc>\n<doc title="B">\n</doc>', 'text only\n', '',
    '</doc>\n<doc title="A">\nx\n</doc></doc>\n</doc>\n<doc title="B">\ny </doc>', '<doc title="A">\nx\nsee </doc>',
    '  <doc title="A">\n x \t\n  </doc>  \nlost\n\t<doc title="B">\n  y\n\t</doc>', '<doc title="A"></doc>\n<doc title="B">\nü\n</doc>\n',
]


def edge_articles(content, first_only=False):
    """The lines one by one."""
    out, lines_, title, inside = [], [], None, False
    for line in content.rstrip().split("\n"):
        bare = line.strip(" \t")
        if bare.startswith("<doc"):
            title, lines_, inside = bare.split('title="')[1].split('"')[0], [], True
        elif bare.startswith("</doc>"):
            if inside:
                out.append((title, " ".join(lines_)))
            inside = False
        else:
            lines_.append(line.strip())
    if not first_only:
        return out
    return out[:1] or ([(title, " ".join(lines_))] if inside else [])


@pytest.mark.parametrize("first_only", [False, True])
@pytest.mark.parametrize("splittable", [False, True])
def test_edges_of_whole_and_split_files(spark, tmp_path, splittable, first_only):
    for i, content in enumerate(EDGES):
        write(tmp_path, f"f{i:02d}", content)
    got = articles.read_articles(spark, str(tmp_path), first_only=first_only, splittable=splittable).orderBy("file", "ord").collect()
    assert [(r["title"], r["article"]) for r in got] == [a for c in EDGES for a in edge_articles(c, first_only)]


def test_articles_across_the_borders_of_splits(spark, tmp_path):
    rng = random.Random(6)
    parts = [f'<doc title="{i}">\n' + "".join(rng.choice(["word ", "see </doc> here ", "\n", " </doc>x", "é "])
             for _ in range(rng.randrange(40))) + "\n</doc>\n" for i in range(60)]
    content = "".join(parts)
    path = write(tmp_path, "f", content)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (97, 256, 1 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            assert read(spark, path, splittable=True) == edge_articles(content)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_manifest_keeps_order_and_limit(spark, tmp_path):
    for name in ("c", "a", "b"):
        write(tmp_path, name, f'<doc title="{name}">\nx\n</doc>\n')
    manifest = lines.read_manifest(spark, write(tmp_path, "list", "c\na\n\nb\n"), limit=2)
    assert sorted(r["path"] for r in manifest.collect()) == ["a", "c"]
    found = articles.read_manifest_articles(spark, manifest, f"{tmp_path}/")
    assert sorted(r["title"] for r in found.collect()) == ["a", "c"]


def test_words(spark, tmp_path):
    path = write(tmp_path, "vocab", "Bank 1234\n  river\t99\n\nTHE 100000\nbank 3\n")
    assert sorted(r[0] for r in lines.read_words(spark, path).collect()) == ["bank", "river", "the"]


WEIGHTS = "Foo_Bar 500\nQ_&amp;_A 20\n\nFoo_Bar 450\na b 3\nZed 700\nFoo_Bar 1\n"


def test_title_weights(spark, tmp_path):
    path = write(tmp_path, "views", WEIGHTS)
    weights = lines.read_title_weights(spark, path)
    assert {r[0]: r[1] for r in weights.collect()} == {"Foo Bar": 1, "Q &amp; A": 20, "Zed": 700}
    assert lines.count_rejected_weights(spark, path).first()[0] == 1
    assert [r[0] for r in lines.top_titles(weights, 2).orderBy(F.desc("pageviews")).collect()] == [
        "Zed", "Q &amp; A",
    ]


def test_first_titles_stop_reading_at_the_nth(spark, tmp_path):
    path = write(tmp_path, "views", WEIGHTS)
    two = {r[0]: r[1] for r in lines.first_titles(spark, path, 2).collect()}
    # the counts after the second distinct title are not read
    assert two == {"Foo Bar": 500, "Q &amp; A": 20}
    three = {r[0]: r[1] for r in lines.first_titles(spark, path, 3).collect()}
    assert three == {"Foo Bar": 450, "Q &amp; A": 20, "Zed": 700}


DOCUMENT = {
    "bank": [{"string": "The bank [closed].\n    ]", "wiki_title": "Foo Bar"},
             {"string": "Ä bank.", "wiki_title": "B"}],
    "river": [{"string": "A river.", "wiki_title": "C"}],
    "none": [],
}


@pytest.mark.parametrize("splittable", [False, True])
def test_examples_document(spark, tmp_path, splittable):
    path = write(tmp_path, "e.json", json.dumps(DOCUMENT, indent=4))
    rows = examples.example_sentences(
        examples.read_examples_document(spark, path, splittable=splittable)
    ).orderBy("word", "n").collect()
    assert [(r["word"], r["n"], r["sentence"], r["title"]) for r in rows] == [
        ("bank", 0, "The bank [closed].\n    ]", "Foo Bar"), ("bank", 1, "Ä bank.", "B"),
        ("river", 0, "A river.", "C"),
    ]


def test_features(spark, tmp_path):
    records = [
        {"linex_index": "bank-0", "original_sentence": "The bank closed.", "features": [
            {"token": "the", "layers": [{"index": -1, "values": [0.5]}]},
            {"token": "bank", "layers": [{"index": -1, "values": [0.1, 0.2]},
                                         {"index": -2, "values": [9.0]}]}]},
        {"linex_index": "bank-1", "original_sentence": "Unseen piece.", "features": []},
    ]
    path = write(tmp_path, "bank.jsonl", "\n".join(json.dumps(r) for r in records))
    read_back = features.read_features(spark, path)
    rows = features.occurrence_vectors(read_back).collect()
    assert [tuple(r) for r in rows] == [("bank", "bank-0:1", "The bank closed.", [0.1, 0.2])]
    assert {r[0]: r[1] for r in features.hover_text(read_back).collect()} == {
        "bank-0": "the bank", "bank-1": "",
    }
    assert [tuple(r) for r in features.count_by_word(read_back).collect()] == [("bank", 2)]
    out = str(tmp_path / "out")
    features.write_features(read_back, out)
    assert features.read_features(spark, f"{out}/word=bank").count() == 2


def test_titles_pairs_and_ids(spark):
    rows = spark.createDataFrame(
        [("a ||| b ||| c", "word-12"), ("a b", "well-known-3"), ("a\nb ||| c", "x-1")], "s string, id string"
    )
    a, b = text.pair_parts(F.col("s"))
    got = rows.select(a, b, text.word_of_id(F.col("id")), text.strip_running_number(F.col("id"))).collect()
    assert [tuple(r) for r in got] == [
        ("a ||| b", "c", "word", "word"), ("a b", None, "well", "wellknown"),
        ("a\nb ||| c", None, "x", "x"),
    ]
    words = spark.range(1).select(text.requested_words("queen-king-queen")).first()[0]
    assert words == ["queen", "king"]


@pytest.mark.parametrize("indent", [None, 1, 4])
def test_examples_documents_of_any_shape(spark, tmp_path, indent):
    """Brackets, quotes and backslashes inside strings, several splits, requested words."""
    rng = random.Random(7)
    document = {word: [{"string": "".join(rng.choice(["a ]", "],", '"', "\\\\", '\\"]', "}], ", "é", " x"]) for _ in range(rng.randrange(9))),
                        "wiki_title": rng.choice(["T", "]", '\\"'])} for _ in range(rng.randrange(4))]
                for word in [*"abcdefgh", 'q"]', "ü", "back\\slash"]}
    path = write(tmp_path, "doc", json.dumps(document, indent=indent))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        for size in ("61", "400", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            for words in (None, ["b", "ü", 'q"]', "none"]):
                for splittable in (True, False):
                    got = examples.read_examples_document(spark, path, words=words, splittable=splittable).collect()
                    assert {r["word"]: [e.asDict() for e in r["examples"]] for r in got} == {
                        w: e for w, e in document.items() if words is None or w in words}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
