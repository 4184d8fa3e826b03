"""Benchmark decontamination by template canonicalisation (operator 5).
DataFrame functions only.

Numbers, names and units of texts and benchmark items become typed
placeholders; what remains is a template. Windows of ``WINDOW`` template tokens
are hash-joined, so a question whose numbers or names were exchanged still
matches. A capital letter makes a name only inside a sentence; in a second form
(``capitals``) every capitalised word is one, whatever stands before it, so names that
open a sentence and items quoted inside one match as well. For matched items with placeholders, the values are compared: a
re-parameterised question replaces equal values by equal values, so item values
and document values must map one to one (slot consistency).

Meetings of windows are grouped into alignments by their offset (place in the
document less place in the item). A document is contaminated by an item when in one
alignment ``CONTAINMENT`` of the item's windows occur and ``CONSISTENCY`` of the
item's slot values are mapped consistently. Windows made of placeholders for more than half match nothing; they
do in the third form (``plain``), lower-cased words and numbers as they stand, which
finds word-for-word copies of items that hardly have a template. Scripts without
spaces count by characters in the last two forms.

Items with fewer than ``MIN_TOKENS`` tokens, or of numbers alone, have no windows that could be
told from chance. They are found word for word where they stand alone (form ``whole``): as whole
clauses, from one mark, line end or end of the text to another.

Defined cases: a null or empty text has no windows and is clean; items with
fewer than ``MIN_WHOLE`` tokens are skipped; an item
shorter than a window is one window; rows are judged one by one, also where
doc_id repeats or is null; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlens.llm import common as C
from barlens.sinks import materialize

WINDOW = 8
MIN_TOKENS = 5
#: Tokens of the shortest item that is looked for as whole clauses.
MIN_WHOLE = 3
CONTAINMENT = 0.5
CONSISTENCY = 0.8
#: Above this many benchmark windows the join is left to Spark instead of broadcast
#: (a window takes about 50 bytes).
BROADCAST_WINDOWS = 500_000

# Words, numbers, and the marks after which a capital letter doesn't make a name.
TOKEN = r"[.!?:\n]|[0-9]+(?:[.,][0-9]+)*|\p{L}+"
# Units that become a placeholder after a number.
UNITS = ("mm", "cm", "m", "km", "g", "kg", "mg", "t", "l", "ml", "s", "sec", "min", "h", "hr", "hours", "minutes",
         "seconds", "days", "weeks", "months", "years", "meters", "metres", "kilometers", "miles", "feet", "inches",
         "pounds", "ounces", "grams", "liters", "litres", "dollars", "cents", "euros", "percent")
NUM, NAME, UNIT = "<num>", "<name>", "<unit>"
SLOTS = (NUM, NAME, UNIT)
#: Forms that are joined, in the order in which they are reported: tokens and what stands for each.
FORMS = {"template": ("toks", "canon"), "capitals": ("chars", "caps"), "plain": ("chars", "raw")}
# Scripts written without spaces: their words count character by character.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def _is_mark(t: Column) -> Column:
    return t.isin(".", "!", "?", ":", "\n")


def _is_number(t: Column) -> Column:
    return F.substring(t, 1, 1).between("0", "9")


def tokenised(rows: DataFrame, name: str = "toks") -> DataFrame:
    """``rows`` with an array of (raw, canon, caps) in place of the text: the lower-cased
    tokens, what they are in the template, and the same with every capitalised word a name;
    and ``chars``, the same with words of unspaced scripts cut into characters."""
    found = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(TOKEN), F.lit(0))

    def one(t: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(F.col("__found"), i - 1))
        first = F.substring(t, 1, 1)
        capital = first != F.lower(first)

        def typed_as(is_name: Column) -> Column:
            return (F.when(_is_number(t), F.lit(NUM)).when(_is_number(before) & F.lower(t).isin(*UNITS), F.lit(UNIT))
                    .when(is_name, F.lit(NAME)).otherwise(F.lower(t)))

        return F.struct(F.lower(t).alias("raw"), typed_as(capital & before.isNotNull() & ~_is_mark(before)).alias("canon"),
                        typed_as(capital).alias("caps"))

    def cut(s: Column) -> Column:
        letters = F.transform(F.split(s["raw"], ""), lambda c: F.struct(c.alias("raw"), c.alias("canon"), c.alias("caps")))
        return F.when(s["raw"].rlike(UNSPACED), letters).otherwise(F.array(s))

    unspaced = F.coalesce(F.col("text").rlike(UNSPACED), F.lit(False))
    split = C.settled(rows.withColumn("__unspaced", unspaced), "__found", found)
    typed = F.filter(F.transform("__found", one), lambda s: ~_is_mark(s["raw"]))
    typed = C.settled(split.drop("text"), name, typed).drop("__found")
    chars = F.when(F.col("__unspaced"), F.flatten(F.transform(name, cut))).otherwise(F.col(name))
    return C.settled(typed, "chars", chars).drop("__unspaced")


def _hash(s: Column, field: str) -> Column:
    """What stands for a token in a window's hash: the raw token's hash or its placeholder's number."""
    out = F.xxhash64(s["raw"])
    for k, slot in enumerate(SLOTS) if field != "raw" else ():
        out = F.when(s[field] == slot, F.lit(k + 1).cast("bigint")).otherwise(out)
    return out


# A token with the mark before it, if one stands there; the token alone is the group.
MARKED = r"(?:[.!?:\n][^\p{L}0-9]*)?([0-9]+(?:[.,][0-9]+)*|\p{L}+)"
#: Placeholders of a token in the template and with every capitalised word a name, as 4 * canon + caps.
KINDS = {NUM: 4 + 1, NAME: 8 + 2, UNIT: 12 + 3}


def hashed_tokens(rows: DataFrame) -> DataFrame:
    """``rows`` with arrays in place of the text: ``toks`` and ``chars``, hashes of the lower-cased tokens
    as in ``tokenised``, and ``toks_kind`` and ``chars_kind``, what stands for them (``KINDS``, 0 where the
    token does). Plain numbers and comparisons of strings, so that a token costs little."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # characters from U+0E00 on are rare in most texts, and quickly looked for
    unspaced = F.coalesce(F.col("text").rlike(r"[^\x00-\u0DFF]") & F.col("text").rlike(UNSPACED), F.lit(False))
    rows = C.settled(rows.withColumn("__unspaced", unspaced), "__bare", F.regexp_extract_all(text, F.lit(MARKED), F.lit(1)))
    rows = C.settled(rows, "__full", F.regexp_extract_all(text, F.lit(MARKED), F.lit(0))).drop("text")

    def number(t: Column) -> Column:
        return (t >= "0") & (t < ":")

    def kind(t: Column, i: Column) -> Column:
        follows = F.get(F.col("__full"), i) == t                 # no mark before it
        initial = F.substring(t, 1, 1)
        capital = F.when(t < "\u0080", (t >= "A") & (t < "[")).otherwise(initial != F.lower(initial))
        counted = (i > 0) & number(F.get(F.col("__bare"), i - 1))
        # most tokens are small letters that follow no number
        return (F.when((t >= "a") & (t < "{") & ~counted, 0).when(number(t), KINDS[NUM])
                .when(counted & follows & F.lower(t).isin(*UNITS), KINDS[UNIT])
                .when(capital, F.when((i > 0) & follows, KINDS[NAME]).otherwise(KINDS[NAME] % 4)).otherwise(0))

    rows = C.settled(rows, "toks", F.transform("__bare", lambda t: F.xxhash64(F.lower(t))))
    rows = C.settled(rows, "toks_kind", F.transform("__bare", kind))
    cut = F.col("__unspaced")
    chars = F.transform("__bare", lambda t, i: F.when(t.rlike(UNSPACED), F.transform(F.split(F.lower(t), ""), lambda c: F.xxhash64(c)))
                        .otherwise(F.array(F.get(F.col("toks"), i))))
    kinds = F.transform("__bare", lambda t, i: F.when(t.rlike(UNSPACED), F.transform(F.split(F.lower(t), ""), lambda c: F.lit(0)))
                        .otherwise(F.array(F.get(F.col("toks_kind"), i))))
    rows = C.settled(rows, "chars", F.when(cut, F.flatten(chars)).otherwise(F.col("toks")))
    return C.settled(rows, "chars_kind", F.when(cut, F.flatten(kinds)).otherwise(F.col("toks_kind"))) \
        .drop("__unspaced", "__bare", "__full")


def _windows(canon: Column, width: Column | int) -> Column:
    """Hash of each window of ``width`` template tokens, by position."""
    width = F.lit(width) if isinstance(width, int) else width
    n = F.size(canon)
    at = F.when(n >= width, F.sequence(F.lit(1), n - width + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.slice(canon, i, width)))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(form, item_id, width, reach, n_windows, at, hash, slots) of every usable benchmark
    window; reach: tokens of the item; slots: array of (place in the window, raw value)."""
    item = tokenised(benchmark.select("item_id", "text"))
    usable = None
    for form, (tokens, field) in FORMS.items():
        one = (item.select("item_id", F.lit(form).alias("form"), F.col(tokens).alias("toks"))
               .filter((F.size("toks") >= MIN_TOKENS) & F.exists("toks", lambda s: ~_is_number(s["raw"]))))
        one = (C.settled(one, "hashes", F.transform("toks", lambda s: _hash(s, field)))
               .withColumn("reach", F.size("toks")).withColumn("width", F.least(F.size("toks"), F.lit(WINDOW))))
        placed = one.select("form", "item_id", "toks", "reach", "width",
                            F.posexplode(_windows(F.col("hashes"), F.col("width"))).alias("at", "hash"))
        window = F.slice("toks", F.col("at") + 1, F.col("width"))
        slots = F.filter(F.transform(window, lambda s, i: F.struct(i.alias("place"), s["raw"].alias("value"),
                                                                   s[field].alias("kind"))),
                         lambda s: s["kind"].isin(*SLOTS))
        placed = placed.select("form", "item_id", "width", "reach", "at", "hash", slots.alias("slots")) \
            .filter(2 * F.size("slots") <= F.col("width"))
        usable = placed if usable is None else usable.unionByName(placed)
    counts = usable.groupBy(F.col("item_id").alias("__item"), F.col("form").alias("__form")).agg(
        F.count(F.lit(1)).alias("n_windows"))
    return usable.join(counts, F.col("item_id").eqNullSafe(F.col("__item")) & (F.col("form") == F.col("__form"))) \
        .drop("__item", "__form")


def document_windows(texts: DataFrame, widths: list[tuple[str, int]]) -> DataFrame:
    """(doc_id, text_hash, form, width, doc_at, hash) of every window of the given (form, width)s.

    A row per place is generated first and its windows are hashed after that, column by column:
    so both steps, and the join that follows, run in compiled code, and no array is sliced.
    """
    if not widths:
        widths = [("template", WINDOW)]
    hashed = hashed_tokens(texts)
    at = F.col("doc_at")
    places = hashed.withColumn("doc_at", F.explode(F.sequence(F.lit(0), F.greatest(F.size("toks"), F.size("chars"), F.lit(1)) - 1)))
    made = []
    for form, width in widths:
        tokens, field = FORMS[form]
        hashes, kinds = F.col(tokens), F.col(f"{tokens}_kind")
        elements = []
        for k in range(width):
            raw, kind = F.get(hashes, at + k), F.get(kinds, at + k)
            slot = F.shiftright(kind, 2) if field == "canon" else kind.bitwiseAND(F.lit(3))
            elements.append(raw if field == "raw" else F.when(slot > 0, slot.cast("bigint")).otherwise(raw))
        made.append(F.when(at + width <= F.size(hashes), F.struct(
            F.lit(form).alias("form"), F.lit(width).alias("width"), F.xxhash64(*elements).alias("hash"))))
    return (places.select("doc_id", "text_hash", "doc_at", F.explode(F.array(*made)).alias("w")).filter(F.col("w").isNotNull())
            .select("doc_id", "text_hash", "w.form", "w.width", "doc_at", "w.hash"))


WHOLE = "whole"


def clauses(rows: DataFrame, name: str = "clauses") -> DataFrame:
    """``rows`` with the text's clauses in its place: lower-cased tokens between marks, joined by spaces."""
    parts = F.split(F.coalesce(F.col("text"), F.lit("")), r"[.!?:\n]+")
    token = F.lit(r"[0-9]+(?:,[0-9]+)*|\p{L}+")
    said = F.transform(parts, lambda x: F.array_join(F.regexp_extract_all(F.lower(x), token, F.lit(0)), " "))
    return C.settled(rows.withColumn("__said", said).drop("text"), name, F.filter("__said", lambda x: x != "")).drop("__said")


def _runs(said: Column, width: Column | int) -> Column:
    """Hash of each run of ``width`` clauses."""
    width = F.lit(width) if isinstance(width, int) else width
    at = F.when(F.size(said) >= width, F.sequence(F.lit(1), F.size(said) - width + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.array_join(F.slice(said, i, width), "\n")))


def whole_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, width, hash) of the items without windows: clauses, and the hash of all of them."""
    item = tokenised(benchmark.select("item_id", "text", F.col("text").alias("__text")))
    short = (F.size("toks") >= MIN_WHOLE) & ((F.size("chars") < MIN_TOKENS) | ~F.exists("toks", lambda s: ~_is_number(s["raw"])))
    said = clauses(item.filter(short).select("item_id", F.col("__text").alias("text")))
    return said.select("item_id", F.size("clauses").alias("width"), F.explode(_runs(F.col("clauses"), F.size("clauses"))).alias("hash"))


def whole_copies(texts: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """Rows of ``contaminated`` for items that stand in a text as whole clauses; None if no item asks for it."""
    items = materialize(whole_items(benchmark), "benchmark-whole")
    widths = [r[0] for r in items.select("width").distinct().collect()]    # few: such items are short
    if not widths:
        return None
    said = clauses(texts)
    runs = F.array(*[F.struct(F.lit(w).alias("w"), _runs(F.col("clauses"), w).alias("h")) for w in widths])
    met = (said.select("doc_id", "text_hash", F.explode(runs).alias("r"))
           .select("doc_id", "text_hash", F.col("r.w").alias("width"), F.explode("r.h").alias("hash"))
           .join(items, ["width", "hash"]).select("doc_id", "text_hash", "item_id").distinct())
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return met.select("doc_id", "item_id", one.alias("n_windows"), one.alias("matched"), F.lit(1.0).alias("containment"),
                      none.alias("n_values"), none.alias("n_consistent"), F.lit("exact").alias("kind"), "text_hash")


def row_key() -> list[Column]:
    """What tells rows apart even where doc_id repeats or is null."""
    return [F.col("doc_id"), F.xxhash64("text").alias("text_hash")]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated (document, item): doc_id, item_id, n_windows, matched,
    containment, n_values, n_consistent, kind (``exact`` where all slot values are the
    item's own, else ``re-parameterised``), text_hash. The figures are those of the
    best alignment of the first form that has one."""
    items = materialize(benchmark_windows(benchmark), "benchmark-windows")
    widths = [tuple(r) for r in items.select("form", "width").distinct().collect()]  # at most WINDOW values a form
    known = items.select("form", "hash", "width", "item_id", "at", "n_windows", "reach")
    if known.count() <= BROADCAST_WINDOWS:
        known = F.broadcast(known)
    texts = docs.select(*row_key(), "text")
    windows = document_windows(texts, widths)
    pair = ["doc_id", "text_hash", "item_id", "form"]
    met = materialize(windows.join(known, ["form", "hash", "width"])
                      .select(*pair, "n_windows", "width", "reach", "at", "doc_at").distinct(), "benchmark-met")
    placed, enough = alignments(met, pair)
    key = [*pair, "scale", "part"]
    values = slot_values(texts, placed, enough, items, key)
    judged = values.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_values"), F.sum(F.when(F.col("images") == 1, 1).otherwise(0)).alias("n_consistent"),
        F.min("same").alias("same"))
    best = (enough.alias("e").join(judged.alias("j"), _same("e", "j", key), "left")
            .select("e.doc_id", "e.text_hash", "e.item_id", "e.form", "e.n_windows", "e.matched",
                    F.coalesce("j.n_values", F.lit(0)).cast("bigint").alias("n_values"),
                    F.coalesce("j.n_consistent", F.lit(0)).cast("bigint").alias("n_consistent"),
                    F.coalesce("j.same", F.lit(True)).alias("same"))
            .filter(F.col("n_consistent") >= F.lit(CONSISTENCY) * F.col("n_values")))
    rank = F.create_map(*[F.lit(x) for i, form in enumerate(FORMS) for x in (form, -i)])
    best = best.groupBy("doc_id", "text_hash", "item_id").agg(F.max(F.struct(
        rank[F.col("form")].alias("rank"), "matched", "same", "n_consistent", "n_values", "n_windows")).alias("b"))
    out = best.select(
        "doc_id", "item_id", "b.n_windows", "b.matched", (F.col("b.matched") / F.col("b.n_windows")).alias("containment"),
        "b.n_values", "b.n_consistent", F.when(F.col("b.same"), "exact").otherwise("re-parameterised").alias("kind"),
        "text_hash")
    whole = whole_copies(texts, benchmark)
    return out if whole is None else out.unionByName(whole)


def _same(a: str, b: str, columns: list[str]) -> list[Column]:
    return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns]


def alignments(met: DataFrame, pair: list[str]) -> tuple[DataFrame, DataFrame]:
    """(one place for each window of every alignment; the alignments that hold enough windows).

    An alignment is a set of meetings whose offsets (doc_at - at) agree: one offset; two
    grids of offsets within ``WINDOW`` and two within the item's length, as names of more
    words move what follows; and the whole document. A copy beside a variant of itself
    and an item that repeats its template are whole in their own alignment.
    """
    possible = (met.groupBy(*pair, "n_windows").agg(F.count_distinct("at").alias("m"))
                .filter(F.col("m") >= F.lit(CONTAINMENT) * F.col("n_windows")))
    shift, reach, whole = F.col("doc_at") - F.col("at"), F.col("reach"), F.lit(0).cast("bigint")
    near = F.lit(WINDOW)
    parts = [whole, shift, F.floor(shift / near), F.floor((shift + near / 2) / near),
             F.floor(shift / reach), F.floor((shift + reach / 2) / reach)]
    part = F.explode(F.array(*[F.struct(F.lit(i).alias("scale"), p.cast("bigint").alias("part"))
                               for i, p in enumerate(parts)])).alias("p")
    placed = materialize(
        met.alias("m").join(possible.alias("o"), _same("m", "o", pair), "left_semi")
        .select(*pair, "n_windows", "at", "doc_at", part)
        .groupBy(*pair, "n_windows", F.col("p.scale").alias("scale"), F.col("p.part").alias("part"), "at")
        .agg(F.min("doc_at").alias("doc_at")), "benchmark-placed")
    return placed, (placed.groupBy(*pair, "n_windows", "scale", "part").agg(F.count(F.lit(1)).alias("matched"))
                    .filter(F.col("matched") >= F.lit(CONTAINMENT) * F.col("n_windows")))


def slot_values(texts: DataFrame, placed: DataFrame, enough: DataFrame, items: DataFrame, key: list[str]) -> DataFrame:
    """For each (alignment, item value): ``images``, 1 if it is mapped one to one,
    and whether it meets itself only. Of the texts, only matched ones are split again."""
    slots = items.select("form", "item_id", "at", F.explode("slots").alias("s"))
    wanted = (placed.alias("m").join(enough.alias("e"), _same("m", "e", key), "left_semi").alias("w")
              .join(slots.alias("s0"), _same("w", "s0", ["form", "item_id", "at"]))
              .select(*[f"w.{c}" for c in key], F.col("s0.s.value").alias("value"),
                      (F.col("w.doc_at") + F.col("s0.s.place")).alias("place")))
    wanted = materialize(wanted, "benchmark-slots")
    # a row per text, with all places that are looked up in it; no token but those leaves the row
    row = ["doc_id", "text_hash"]
    asked = (wanted.groupBy(*row).agg(F.collect_set(F.struct("form", "place")).alias("__asked"))
             .select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t"), "__asked"))
    same_row = F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_hash") == F.col("__t"))
    split = tokenised(texts.join(asked, same_row).dropDuplicates(row))
    image = F.lit(None).cast("string")
    for form, (tokens, _) in FORMS.items():
        image = F.when(F.col("p.form") == form, F.get(F.col(tokens), F.col("p.place"))["raw"]).otherwise(image)
    found = (split.withColumn("p", F.explode("__asked"))
             .select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t"), F.col("p.form").alias("__f"),
                     F.col("p.place").alias("__place"), image.alias("image")))
    met_values = (wanted.join(found, same_row & (F.col("form") == F.col("__f")) & (F.col("place") == F.col("__place")))
                  .select(*key, "value", "image").distinct())
    # a consistent value has one image, and is the only one that has it
    by_value, by_image = Window.partitionBy(*key, "value"), Window.partitionBy(*key, "image")
    paired = (met_values.withColumn("images", F.count(F.lit(1)).over(by_value))
              .withColumn("origins", F.count(F.lit(1)).over(by_image)))
    return paired.groupBy(*key, "value").agg(
        F.max(F.greatest("images", "origins")).alias("images"), F.min(F.col("image") == F.col("value")).alias("same"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without its contaminated rows."""
    d, t = C.fresh(docs, "bad_id"), C.fresh(docs, "bad_text")
    bad = materialize(contaminated(docs, benchmark).select(
        F.col("doc_id").alias(d), F.col("text_hash").alias(t)).distinct(), "contaminated")
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(t)), "left_anti")


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark).drop("text_hash")
