from pyspark.sql import functions as F

from barlens.llm import decontamination as X

ITEM = "Tom has 12 apples and gives 5 apples to Anna. How many apples does Tom have after walking 3 km?"


def tables(spark, items, docs):
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))


def found(spark, items, docs):
    d, b = tables(spark, items, docs)
    return {(r["doc_id"], r["item_id"]): r["kind"] for r in X.digest(d, b).collect()}


def test_reparameterised_questions(spark):
    docs = [
        (1, f"Before it. {ITEM} After it."),
        (2, "Then Bob has 40 apples and gives 7 apples to Zoe. How many apples does Bob have after walking 9 miles?"),
        # two numbers became one, and one name two
        (3, "Then Bob has 40 apples and gives 40 apples to Bob. How many apples does Kim have after walking 9 miles?"),
        (4, "Tom likes apples. He walks a lot and gives some of them to Anna, who has many."),
    ]
    assert found(spark, [(1, ITEM)], docs) == {(1, 1): "exact", (2, 1): "re-parameterised"}


def test_numbers_alone_match_word_for_word_only(spark):
    numbers = "1 2 3 4 5 6 7 8 9 10"
    docs = [(1, "10 9 8 7 6 5 4 3 2 1"), (2, numbers), (3, f"It went {numbers}"), (4, f"So it went:\n{numbers}.\nAnd on.")]
    assert found(spark, [(1, numbers)], docs) == {(2, 1): "exact", (4, 1): "exact"}


def test_short_items(spark):
    """Items too short for a window are found as whole clauses, and nowhere else."""
    items = [(1, "one two three"), (2, "alpha beta gamma delta epsilon zeta"), (3, "Is 17 prime?"), (4, "True? False."), (5, "Go on. Then stop.")]
    docs = [(1, "so one two three it is"), (2, "x alpha beta gamma delta epsilon zeta y"), (3, "alpha beta gamma delta"),
            (4, "He counted: One, two, THREE! And went."), (5, "Then he asked\nis 17 prime?\nand left"), (6, "Is 18 prime? Is 17 primed?"),
            (7, "True or not? False."), (8, "They said go on. Then stop."), (9, "Go on.\nThen stop"), (10, "True? False.")]
    assert found(spark, items, docs) == {(2, 2): "exact", (4, 1): "exact", (5, 3): "exact", (9, 5): "exact"}
    d, b = tables(spark, items, docs)
    assert sorted(r["doc_id"] for r in X.decontaminate(d, b).collect()) == [1, 3, 6, 7, 8, 10]
    r = X.digest(d, b).filter("doc_id = 5").first()
    assert (r["n_windows"], r["matched"], r["containment"], r["n_values"], r["n_consistent"]) == (1, 1, 1.0, 0, 0)


def test_whole_table_against_substrings(documents, texts, spark):
    """In sf0.01 benchmark passages stand in documents word by word."""
    from barlens.llm.common import table
    from tests.llm.conftest import SF
    benchmark = table(spark, SF, "benchmark")
    import re
    words = lambda t: " ".join(re.findall(r"[^\W\d_]+|[0-9]+", t.lower()))
    items = {r["item_id"]: words(r["text"]) for r in benchmark.collect()}
    expected = {(d, i) for d, t in texts.items() for w in [words(t)] for i, x in items.items() if x in w}
    got = X.digest(documents, benchmark)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == expected and expected
    assert X.decontaminate(documents, benchmark).count() == len(texts) - len({d for d, _ in expected})


def test_broadcast_bound_changes_the_plan_only(spark, monkeypatch):
    docs = [(i, f"text {i}. {ITEM}" if i % 3 == 0 else "clean text of some words here indeed") for i in range(30)]
    d, b = tables(spark, [(1, ITEM)], docs)
    rows = sorted(map(tuple, X.digest(d, b).collect()))
    monkeypatch.setattr(X, "BROADCAST_WINDOWS", 0)
    assert sorted(map(tuple, X.digest(d, b).collect())) == rows and len(rows) == 10


def test_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "the same words stand here twice in two rows"), (None, None), (2, ""),
                                   (None, "a row without any id has a text of its own")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in X.digest(odd, items).collect()}
    assert got == {(5, 1), (6, 1), (None, None)}
    left = X.decontaminate(odd, items)
    assert left.columns == odd.columns and left.count() == odd.count() - 3
    assert left.filter(F.col("doc_id").isNull()).count() == 1  # the other row without id stays
    assert X.digest(empty, items).count() == 0 and X.digest(odd, items.limit(0)).count() == 0
    assert X.decontaminate(odd, items.limit(0)).count() == odd.count()


def test_main_path_runs_no_python(documents, spark):
    from barlens.llm.common import table
    from tests.llm.conftest import SF
    plan = X.digest(documents, table(spark, SF, "benchmark"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_repeated_templates_and_variants_before_the_copy(spark):
    twice = "Tom has 3 red apples and 5 green pears. Ann has 7 red apples and 9 green pears."
    drive = "Every week John drives 12 km to work and 5 km to Mary. How many km does John drive every week?"
    variant = "Every week Bill drives 30 km to work and 8 km to Sue."
    docs = [(1, f"Before it. {twice} After it."), (2, f"{variant} {drive}"), (3, f"{drive} {variant}"), (4, variant)]
    got = found(spark, [(1, twice), (2, drive)], docs)
    assert got == {(1, 1): "exact", (2, 2): "exact", (3, 2): "exact"}


def test_names_that_open_sentences(spark):
    picks = "Tom picks 12 apples on Monday. Tom gives 5 apples to his sister. Tom eats 3 apples. How many apples are left?"
    items = [(1, picks), (2, "What is the capital of France?")]
    docs = [(1, picks.replace("Tom", "Kim").replace("12", "14")), (2, 'He asked "What is the capital of France?" again.'),
            (3, "Somebody asked what is the best way to the town."), (4, picks.replace("Tom", "Kim").replace("12", "5").replace("3", "5"))]
    assert found(spark, items, docs) == {(1, 1): "re-parameterised", (2, 2): "exact"}


def test_verbatim_copies_without_a_template(spark):
    items = [(1, "Compute 3 + 4 * 5 - 2."), (2, "WHAT IS THE CAPITAL CITY OF FRANCE"),
             (3, "小明有三个苹果，他又买了五个，现在一共有几个？"), (4, "Anna, Ben, Carla, Dora and Emil Meet Fritz Gauss In Bonn")]
    docs = [(i, f"Before it: {t} After it.") for i, t in items] + [(5, items[3][1].lower()), (6, "小明有三本书。"), (7, "Compute 9 + 4 * 5 - 2.")]
    assert found(spark, items, docs) == {**{(i, i): "exact" for i in range(1, 5)}, (5, 4): "exact"}
