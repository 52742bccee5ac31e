"""Benchmark decontamination by template canonicalisation, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Units of measure, and words for numbers.
UNITS = "km cm mm kg mg lb lbs oz ml mph kmh hour hours minute minutes second seconds day days week weeks month months year years mile miles meter meters metre metres inch inches feet foot gram grams liter liters litre litres dollar dollars cent cents euro euros percent degrees".split()
NUMBERS = "zero two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million".split()
#: What separates words, the marks taken off a word's ends, and ends of sentences.
SPACE = r"[\x20\x09-\x0D]+"
EDGES = r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SENTENCE_END = r"[.!?:][\x22\x27)\]]*$"
FIGURE = r"^[0-9][0-9.,:/]*$"
MEASURE = rf"^[0-9][0-9.,:/]*({'|'.join(UNITS)})$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def cores(raw: Column) -> Column:
    """The words without marks at their ends."""
    return F.transform(raw, lambda w: F.btrim(w, F.lit(MARKS)))


def small(word: Column) -> Column:
    """The word with A-Z in lower case."""
    return F.when(F.length(word) == F.octet_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def capital(word: Column) -> Column:
    """Whether the word starts with A-Z."""
    return (F.ascii(word) <= ord("Z")) & (F.ascii(word) >= ord("A"))


def template(raw: Column, core: Column, low: Column) -> Column:
    """Each word in lower case (A-Z; low), or a placeholder of its type.

    <num>: figures and number words.  <unit>: a unit of measure; <num><unit>: both in one word.  <name>: a word that
    starts with A-Z but no sentence (the first word, or one after . ! ? or :).  Few steps for a word that starts with
    a small letter, which most do.
    """

    def typed(c: Column, i: Column) -> Column:
        word = F.get(low, i)
        figure = F.when(c.rlike(FIGURE), "<num>").when(word.rlike(MEASURE), "<num><unit>").otherwise(word)
        named = F.when((i > 0) & ~F.get(raw, i - 1).rlike(SENTENCE_END), "<name>").otherwise(word)
        known = F.when(word.isin(NUMBERS + UNITS), F.when(word.isin(NUMBERS), "<num>").otherwise("<unit>")).otherwise(word)
        return F.when(F.ascii(c) > ord("Z"), known).when(capital(c), named).when(F.ascii(c).between(ord("0"), ord("9")), figure).otherwise(known)

    return F.transform(core, typed)


def starts(core: Column, t: Column) -> Column:
    """For each word, null; for one that starts a sentence and with A-Z, its type: <num>, <unit> or <name>."""

    def typed(c: Column, i: Column) -> Column:
        own = F.get(t, i)
        kind = F.when(own.isin(NUMBERS), "<num>").when(own.isin(UNITS), "<unit>").otherwise("<name>")
        return F.when(capital(c) & (own != "<name>"), kind)

    return F.transform(core, typed)


def _templates(table: DataFrame, *keep: str) -> DataFrame:
    """keep, core, t (the template) and s (see starts()) of each row; each array is computed once."""
    raw = table.select(*keep, words(F.col("text")).alias("raw"))
    core = raw.select(*keep, "raw", cores(F.col("raw")).alias("core"))
    low = core.select(*keep, "raw", "core", F.transform("core", small).alias("low"))
    both = low.select(*keep, "core", template(F.col("raw"), F.col("core"), F.col("low")).alias("t"))
    return both.select(*keep, "core", "t", starts(F.col("core"), F.col("t")).alias("s"))


def wide(at: Column) -> Column:
    """The word of the template at this place, or its type where it starts a sentence."""
    return F.coalesce(F.get("s", at), F.get("t", at))


def _hashes(width: int, at: Column, word, *more: Column) -> Column:
    """pos and h (and more) of the windows of so many words (word: from a place) that start at these places."""
    return F.transform(at, lambda i: F.struct(i.alias("pos"), F.xxhash64(*(word(i + j) for j in range(width))).alias("h"), *more))


def _strict(at: Column) -> Column:
    return F.get("t", at)


def _windows(templates: DataFrame, width: int, *keep: str) -> DataFrame:
    """keep, pos, h and strict of each window of the template (strict), and of those over the start of a sentence with its type; none for a shorter text.

    No filter on the size: pushed below the arrays, it would compute them again for each word.
    """
    last = F.size("t") - width
    placed = templates.select(*keep, "t", "s", F.filter(F.sequence(F.lit(0), F.size("t")), lambda i: F.get("s", i).isNotNull()).alias("other"))
    over = F.flatten(F.transform("other", lambda i: F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda j: i - j)))
    over = F.array_distinct(F.filter(over, lambda i: (i >= 0) & (i <= last)))
    both = F.concat(_hashes(width, F.sequence(F.lit(0), last), _strict, F.lit(True).alias("strict")), _hashes(width, over, wide, F.lit(False).alias("strict")))
    each = placed.select(*keep, F.explode(F.when(last >= 0, both)).alias("x"))
    return each.select(*keep, "x.pos", "x.h", "x.strict")


#: Windows of benchmark items, and ids of documents, up to which they are broadcast (some 60 MB); more are joined by shuffling.
BROADCAST_ROWS = 1_000_000


#: What tells texts apart, where rows repeat a doc_id.
DOC = ["doc_id", "doc_tag"]


def _found(docs: DataFrame, items: DataFrame, width: int, literals: int, similarity: float) -> DataFrame:
    """doc_id, doc_tag (a hash of the text), item_id, covered and n_words: see contaminated()."""
    item = _templates(items.filter("item_id is not null").select("item_id", "text", F.xxhash64("text").alias("tag")).distinct(), "item_id", "tag")
    item = item.filter(F.size("t") >= width).select("*", F.size("t").alias("n_words"), F.transform("t", lambda x, i: F.coalesce(F.get("s", i), x)).alias("g"))
    item = item.select("*", F.exists("g", lambda x: x.startswith("<")).alias("slotted"))
    typed = F.arrays_zip(F.col("core").alias("core"), F.col("t").alias("t"), F.transform("t", lambda x, i: F.coalesce(F.get("s", i), x)).alias("g"))
    slots = item.select("item_id", "tag", F.posexplode(typed).alias("pos", "x")).filter(F.col("x.g").startswith("<"))
    slots = slots.select("item_id", "tag", "pos", F.col("x.t").alias("item_t"), F.col("x.g").alias("item_g"), small(F.col("x.core")).alias("item_value"))
    begins = F.sequence(F.lit(0), F.col("n_words") - width)
    plain = lambda name: F.transform(begins, lambda i: F.size(F.filter(F.slice(name, i + 1, width), lambda x: ~x.startswith("<"))))
    held = [item.select("item_id", "tag", "n_words", "slotted", F.explode(F.arrays_zip(_hashes(width, begins, word).alias("x"), plain(n).alias("p"))).alias("y"), F.lit(n == "t").alias("item_strict")) for n, word in (("t", _strict), ("g", wide))]
    held = held[0].union(held[1]).filter(F.col("y.p") >= literals).select(F.col("y.x.h").alias("h"), "item_id", "tag", "n_words", "slotted", F.col("y.x.pos").alias("ipos"), "item_strict")
    held = held.groupBy(*(c for c in held.columns if c != "item_strict")).agg(F.max("item_strict").alias("item_strict"))
    if held.count() <= BROADCAST_ROWS:
        held = F.broadcast(held)
    named = docs.filter("doc_id is not null").select("doc_id", "text", F.xxhash64("text").alias("doc_tag"))
    seen = _windows(_templates(named, *DOC), width, *DOC).withColumnRenamed("pos", "dpos")
    found = seen.join(held, "h").select(*DOC, "item_id", "tag", "n_words", "slotted", (F.col("dpos") - F.col("ipos")).alias("diagonal"), "ipos", (F.col("strict") & F.col("item_strict")).alias("strict"))
    found, _ = written(found.groupBy(*(c for c in found.columns if c != "strict")).agg(F.max("strict").alias("strict")), "windows")
    key = [*DOC, "item_id", "tag", "diagonal"]
    reached = found.select(*key, "n_words", "slotted", F.explode(F.sequence("ipos", F.col("ipos") + width - 1)).alias("pos"), "strict")
    reached = reached.groupBy(*key, "n_words", "slotted", "pos").agg(F.max("strict").alias("strict"))
    wanted = found.filter("slotted").select(*DOC).distinct()
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    some = named.join(wanted, DOC, "left_semi")
    values = _templates(some, *DOC).select(*DOC, F.posexplode(typed).alias("at", "x")).filter(F.col("x.g").startswith("<"))
    values = values.select(*DOC, "at", F.col("x.t").alias("t"), small(F.col("x.core")).alias("value"))
    pairs = reached.filter("slotted").join(slots, ["item_id", "tag", "pos"]).withColumn("at", (F.col("pos") + F.col("diagonal")).cast("int")).join(values, [*DOC, "at"])
    pairs, _ = written(pairs, "slots")  # read by each of the rules below; texts are read once for all

    def broken(among: DataFrame) -> DataFrame:
        """Diagonals where a value becomes several, or several become one."""
        forward = among.groupBy(*key, "item_value").agg((F.min("value") != F.max("value")).alias("differs"))
        back = among.groupBy(*key, "value").agg((F.min("item_value") != F.max("item_value")).alias("differs"))
        return forward.filter("differs").select(*key).union(back.filter("differs").select(*key)).distinct()

    def enough(kept: DataFrame) -> DataFrame:
        covered = kept.groupBy(*DOC, "item_id", "tag", "n_words").agg(F.count_distinct("pos").alias("covered"))
        covered = covered.filter(F.col("covered") >= F.col("n_words") * F.lit(similarity) - 1e-9)
        return covered.groupBy(*DOC, "item_id").agg(F.max(F.struct(F.col("covered") / F.col("n_words"), "covered", "n_words")).alias("b"))

    typed_both = "item_t like '<%' and t like '<%'"
    literal = enough(reached.filter("strict").join(broken(pairs.filter(f"strict and {typed_both}")), key, "left_anti"))
    changed = pairs.filter("value != item_value and not (item_t = '<name>' and t = '<name>')")
    several = pairs.groupBy(*key, "item_value").agg(F.min("value").alias("a"), F.max("value").alias("z")).filter("a != z").select(*key, "item_value")
    shared = pairs.filter("item_g = '<name>'").groupBy(*key, "value").agg(F.min("item_value").alias("a"), F.max("item_value").alias("z")).filter("a != z").select(*key, "value")
    off = changed.join(several, [*key, "item_value"], "left_semi").select(*key, "pos").union(changed.filter("item_g = '<name>'").join(shared, [*key, "value"], "left_semi").select(*key, "pos"))
    names = broken(pairs.filter("item_t = '<name>' and t = '<name>'"))
    free = enough(reached.join(names, key, "left_anti").join(off, [*key, "pos"], "left_anti"))
    best = literal.union(free.join(literal, [*DOC, "item_id"], "left_anti").select(*literal.columns))
    return best.select(*DOC, "item_id", "b.covered", F.col("b.n_words").cast("long").alias("n_words"))


def contaminated(docs: DataFrame, items: DataFrame, width: int = 5, literals: int = 2, similarity: float = 0.8) -> DataFrame:
    """doc_id, item_id, covered and n_words: the documents that hold an item, as it is or with other parameters.

    docs: doc_id, text.  items: item_id, text.  Texts become templates (see template()); every window of `width`
    template words that has `literals` ordinary words at least is looked up by hash.  Windows of one document and
    item that lie on one diagonal are aligned word by word; there each name of the item must always become the
    same name in the document and no two the same, else that diagonal doesn't count.  Words that start a sentence
    may be names: windows are also looked up with them as placeholders (see starts()).  Where one of these, or a
    figure or unit, becomes several values, or two such sentence starts the same one, only the words that
    changed don't count; different numbers may become equal.  A pair that is found by the template alone, without
    these liberties and with every value kept apart, has the words covered that way.  covered: how many of the item's n_words words lie
    in windows found.  A pair is returned if covered is at least similarity * n_words.

    Nulls: a text counts as empty; a row without doc_id or item_id takes no part.  Rows that repeat a doc_id are
    judged each for itself and give one row for the best; items that repeat an id are judged each for itself and give one row for the best.  Items of
    fewer words than a window are never found.  Empty tables: an empty result.

    Documents aren't shuffled: the items' windows are broadcast (their number is checked; beyond, a shuffled hash
    join does the same).  Only windows found go on, written once; the texts of documents are read a second time
    only for those that share windows having placeholders.
    """
    found = _found(docs, items, width, literals, similarity)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("covered") / F.col("n_words"), "covered", "n_words")).alias("b"))
    return best.select("doc_id", "item_id", "b.covered", "b.n_words")


def decontaminated(docs: DataFrame, items: DataFrame, width: int = 5, literals: int = 2, similarity: float = 0.8) -> DataFrame:
    """docs without the texts in which contaminated() finds an item; rows without a doc_id stay.

    Of rows that repeat a doc_id only those with such a text go.
    """
    found = _found(docs, items, width, literals, similarity).select(F.col("doc_id").alias("_leak_id"), F.col("doc_tag").alias("_leak_tag")).distinct()
    return docs.join(found, (F.col("doc_id") == F.col("_leak_id")) & (F.xxhash64("text") == F.col("_leak_tag")), "left_anti").select(*docs.columns)


def _list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


_TYPED_SQL = f"""case when c[1] between '0' and '9' then
             case when regexp_matches(c, '{FIGURE}') then '<num>' when regexp_matches(low, '{MEASURE}') then '<num><unit>' else low end
           when c[1] between 'A' and 'Z' then case when j > 1 and not regexp_matches(before, '{SENTENCE_END}') then '<name>' else low end
           when low in ({_list(NUMBERS)}) then '<num>' when low in ({_list(UNITS)}) then '<unit>' else low end"""


def contaminated_sql(width: int = 5, literals: int = 2, percent: int = 80) -> str:
    def typed(name: str, table: str, key: str) -> str:
        return f"""{name}_w as (select {key}, list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda x: x <> '') as ws from {table}),
{name}_e as (select {key}, unnest(ws) as w, unnest([null] || ws[:-2]) as before, unnest(range(1, len(ws) + 1)) as j from {name}_w),
{name}_c as (select *, regexp_replace(w, '{EDGES}', '', 'g') as c from {name}_e),
{name}_l as (select *, translate(c, '{UPPER}', '{LOWER}') as low from {name}_c),
{name} as (select {key}, j - 1 as pos, low as value, {_TYPED_SQL} as t from {name}_l),
{name}_k as (select {key}, pos, string_agg(t, ' ') over w as k, count(*) over w as n, sum((t not like '<%')::int) over w as plain
             from {name} window w as (partition by {key} order by pos rows between current row and {width - 1} following))"""

    return f"""
with {typed("d", "documents", "doc_id")},
{typed("b", "benchmark", "item_id")},
size as (select item_id, count(*) as n_words from b group by 1),
found as (select distinct doc_id, item_id, d_k.pos - b_k.pos as diagonal, b_k.pos as ipos
          from d_k join b_k using (k) where d_k.n = {width} and b_k.n = {width} and b_k.plain >= {literals}),
reached as (select distinct doc_id, item_id, diagonal, ipos + unnest(range(0, {width})) as pos from found),
pairs as (select doc_id, item_id, diagonal, b.value as item_value, d.value as value
          from reached join b using (item_id, pos) join d using (doc_id) where d.pos = reached.pos + diagonal and b.t like '<%'),
broken as (select distinct doc_id, item_id, diagonal from (
           select doc_id, item_id, diagonal from pairs group by doc_id, item_id, diagonal, item_value having count(distinct value) > 1
           union all select doc_id, item_id, diagonal from pairs group by doc_id, item_id, diagonal, value having count(distinct item_value) > 1)),
covered as (select doc_id, item_id, count(distinct pos) as covered from reached anti join broken using (doc_id, item_id, diagonal) group by 1, 2)
select doc_id, item_id, covered, n_words from covered join size using (item_id) where covered * 100 >= n_words * {percent}
"""
