"""Line deduplication by a deletion-neighbourhood join, in DataFrame expressions only.

Lines are compared as lists of words. Equal lines meet by the hash of their words. Lines within one edit (a word
replaced, put in or left out) meet by hashed keys: for each word, the line without it, with the word's place for
replaced words. Such keys are made only for lines whose first or last words, about a third of the line, are also
those of another line of the right length, as any line within one edit has one of the two unchanged. Pairs are verified
before a line goes. Of lines that meet only the smallest position is gathered, which Spark combines before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitloom.llm.batches import free_name
from visitloom.session import through_storage

# Lines of fewer words must be equal to meet.
LEAST_WORDS = 10
# A position is doc_id * LINES + line number, as a decimal of 38 digits.
LINES = 10**12

# White space within a line becomes single blanks; texts that have no other are the common case.
_OTHER_SPACE = " OR ".join(rf"contains(text, '{c}')" for c in (r"\t", r"\r", r"\u000b", r"\u000c", "  "))
_LINE = r"""btrim(CASE WHEN other_space THEN regexp_replace(line, '[ \t\r\u000b\u000c]+', ' ') ELSE line END)"""


def _lines(documents: DataFrame) -> DataFrame:
    """(doc_id, row_key, line_no, position, line) of all lines but blank ones."""
    texts = documents.select("doc_id", "row_key", "text", F.expr(f"{_OTHER_SPACE} AS other_space"))
    lines = texts.select("doc_id", "row_key", "other_space", F.expr(r"posexplode(split(text, '\n')) AS (line_no, line)"))
    lines = lines.select("doc_id", "row_key", "line_no", F.expr(f"{_LINE} AS line"))
    return lines.where("line <> ''").withColumn("position", F.expr(_position("doc_id", "line_no")))


def _position(doc_id: str, line_no: str) -> str:
    return f"CAST(CAST({doc_id} AS decimal(19,0)) * {LINES}L + {line_no} AS decimal(38,0))"


def _anchor_length(n: str) -> str:
    """Words of an anchor: the largest 5 * 2^k of which two fit into n words."""
    return f"5 * shiftleft(1, length(bin({n} div {LEAST_WORDS})) - 1)"


def _anchor(side: str, length: str) -> str:
    return f"xxhash64('{side}', substring_index(line, ' ', {length if side == 'first' else f'-({length})'}))"


def _distinct_lines(documents: DataFrame) -> DataFrame:
    """(k1, k2, first position, row_key there, last position, n words, anchors) of each distinct line."""
    long, second = f"n >= {LEAST_WORDS}", f"n > {LEAST_WORDS} AND {_anchor_length('n')} <> {_anchor_length('(n - 1)')}"
    lines = _lines(documents).withColumn("n", F.expr("octet_length(line) - octet_length(replace(line, ' ', '')) + 1"))
    anchors = [
        F.expr(f"CASE WHEN {condition} THEN {_anchor(side, _anchor_length(n))} END AS {name}")
        for name, side, condition, n in (
            ("a1", "first", long, "n"),
            ("a2", "last", long, "n"),
            ("a3", "first", second, "(n - 1)"),
            ("a4", "last", second, "(n - 1)"),
        )
    ]
    keyed = lines.select(*_line_keys(), "position", "row_key", "n", *anchors)
    return keyed.groupBy("k1", "k2").agg(
        F.min("position").alias("first"),
        F.min_by("row_key", "position").alias("row_key"),
        F.max("position").alias("last"),
        *(F.min(c).alias(c) for c in ("n", "a1", "a2", "a3", "a4")),
    )


def _line_keys() -> list[Column]:
    return [F.expr("xxhash64(line) AS k1"), F.expr("xxhash64(1, line) AS k2")]


def _wanted_keys(distinct: DataFrame) -> DataFrame:
    """Distinct lines that may have a partner: (position, row_key, for_replaced, for_longer, for_shorter).

    At an anchor, a line meets lines of as many words under that number, and lines of one word less or more under
    the smaller number; it comes there as the shorter or the longer one.
    """
    anchors = "explode(filter(array(a1, a2, a3, a4), a -> a IS NOT NULL)) AS anchor"
    meets = distinct.where(f"n >= {LEAST_WORDS}").select(
        F.col("first").alias("position"), "row_key", "k1", "n", F.expr(anchors)
    )
    roles = "explode(array(named_struct('n', n, 'longer', false), named_struct('n', n - 1, 'longer', true))) AS role"
    meets = meets.select("position", "row_key", "k1", "anchor", F.expr(roles)).select(
        "position", "row_key", "k1", F.expr("xxhash64(anchor, role.n) AS meeting"), F.expr("role.longer AS longer")
    )
    groups = meets.groupBy("meeting").agg(
        F.expr("min(CASE WHEN NOT longer THEN k1 END) < max(CASE WHEN NOT longer THEN k1 END) AS same"),
        F.expr("bool_or(longer) AND bool_or(NOT longer) AS other"),
    )
    groups = groups.where("same OR other")
    return (
        meets.join(groups, "meeting")
        .groupBy("position", "row_key")
        .agg(
            F.expr("bool_or(NOT longer AND coalesce(same, false)) AS for_replaced"),
            F.expr("bool_or(longer AND other) AS for_longer"),
            F.expr("bool_or(NOT longer AND other) AS for_shorter"),
        )
        .where("for_replaced OR for_longer OR for_shorter")
    )


def _running_xor(values: str) -> str:
    """The xor of all values up to each place, in as many passes as the length has binary digits."""
    return f"""aggregate(sequence(0, length(bin(size({values})))), {values},
        (x, k) -> transform(x, (v, i) -> v ^ coalesce(get(x, i - shiftleft(1, k)), 0L)))"""


def _variant_keys(lines: DataFrame) -> DataFrame:
    """(key, longer, position, row_key): hashed keys of the deletion neighbourhoods.

    A key of replaced words has longer null: the line without word i, and i. For lines of one word less or more it is
    the whole shorter line (longer false), or the longer line without word i (longer true).
    """
    xors = lines.select(
        "position", "row_key", "for_replaced", "for_longer", "for_shorter",
        F.size("words").alias("n"),
        F.expr("transform(words, (w, i) -> xxhash64(w, i)) AS own"),
        F.expr(f"CASE WHEN for_longer THEN {_running_xor('transform(words, (w, i) -> xxhash64(w, i))')} END AS up_to"),
        F.expr(f"CASE WHEN for_longer THEN {_running_xor('transform(words, (w, i) -> xxhash64(w, i - 1))')} END AS moved"),
    ).withColumn("whole", F.expr("aggregate(own, 0L, (x, v) -> x ^ v)"))
    keys = F.expr("""explode(concat(
        CASE WHEN for_replaced THEN transform(own, (v, i) ->
            named_struct('key', xxhash64('replaced', n, i, whole ^ v), 'longer', CAST(NULL AS boolean)))
            ELSE array() END,
        CASE WHEN for_shorter THEN array(named_struct('key', xxhash64('other', n, whole), 'longer', false))
            ELSE array() END,
        CASE WHEN for_longer THEN transform(own, (v, i) -> named_struct('key', xxhash64('other', n - 1,
            coalesce(get(up_to, i - 1), 0L) ^ moved[n - 1] ^ moved[i]), 'longer', true)) ELSE array() END)) AS variant""")
    return xors.select("position", "row_key", keys).select("position", "row_key", "variant.key", "variant.longer")


def _within_one_edit(a: str, b: str) -> str:
    """Whether two lists of words are within one edit, words being replaced, put in or left out."""
    differing = f"filter(zip_with({a}, {b}, (x, y) -> NOT (x <=> y)), d -> d)"

    def without_one(long: str, short: str) -> str:
        # The longer list without the word at the first place where they differ is the shorter one.
        differ = f"array_position(zip_with({long}, {short}, (x, y) -> NOT (x <=> y)), true)"
        at = f"CAST(coalesce(nullif({differ}, 0), size({long})) AS int)"
        return f"(slice({long}, {at} + 1, size({long})) = slice({short}, {at}, size({long})))"

    return f"""CASE size({a}) - size({b}) WHEN 0 THEN size({differing}) <= 1
        WHEN 1 THEN {without_one(a, b)} WHEN -1 THEN {without_one(b, a)} ELSE false END"""


def _near_removed(lines: DataFrame) -> DataFrame:
    """(position, row_key) of the given lines that have an earlier one within one edit among them."""
    variants = _variant_keys(lines)
    least = variants.groupBy("key").agg(
        F.min("position").alias("least"),
        F.expr("min(CASE WHEN longer THEN position END) AS longer_least"),
        F.expr("min(CASE WHEN NOT longer THEN position END) AS shorter_least"),
        F.max("position").alias("most"),
    )
    least = least.where("least < most").drop("most")
    partner = F.expr("CASE WHEN longer THEN shorter_least WHEN NOT longer THEN longer_least ELSE least END")
    pairs = variants.join(least, "key").select("position", "row_key", partner.alias("earlier"))
    words = lines.select("position", "row_key", "words")
    both = (
        pairs.where("earlier < position")
        .distinct()
        .join(words, ["position", "row_key"])
        .join(words.select(F.col("position").alias("earlier"), F.col("words").alias("earlier_words")), "earlier")
    )
    return both.where(_within_one_edit("words", "earlier_words")).select("position", "row_key").distinct()


def dedup_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`documents` without the lines that have an earlier equal or nearly equal one, and the number of lines gone.

    Lines are parted by line feeds and compared as words between blanks, tabs and other ASCII white space. A line is
    earlier by its doc_id, then its line number. Equal lines: the first place stays. A distinct line of LEAST_WORDS or
    more words, by its first place, goes everywhere if an earlier distinct line of LEAST_WORDS or more is within one edit: one
    word replaced, put in or left out. That earlier line may be gone as well. Blank lines stay. The text is changed only by
    leaving out lines; `lines_removed` is added. A null text stays null. Rows with a null doc_id take no part and stay as
    they are. Repeated rows are treated alike: what one keeps the other keeps, as lines at one place of one doc_id are
    equally early. Other columns, whatever their names, stay; an empty table gives an empty result.
    """
    count = free_name(documents, "lines_removed")
    named = documents.where(F.col(doc_id).isNotNull())
    columns = {c: f"c{i}" for i, c in enumerate(documents.columns)}
    plain = named.select(F.col(doc_id).cast("long").alias("doc_id"), *(F.col(c).alias(n) for c, n in columns.items()))
    row_key = F.xxhash64(*(columns[c] for c, kind in documents.dtypes if "map<" not in kind and kind != "variant"))
    # Dealt out by doc_id once, for the lines whose words are needed and for the result: all columns are used by both.
    dealt = plain.repartition("doc_id").withColumn("row_key", row_key).withColumn("text", F.col(columns[text]))
    source = plain.select("doc_id", row_key.alias("row_key"), F.col(columns[text]).alias("text"))

    distinct = through_storage(_distinct_lines(source), "lines")
    wanted = through_storage(_wanted_keys(distinct), "wanted-lines")
    flags = ("for_replaced", "for_longer", "for_shorter")
    by_doc = (
        wanted.withColumn("doc_id", F.expr(f"CAST((position - pmod(position, {LINES}L)) div {LINES}L AS bigint)"))
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("position", "row_key", *flags)).alias("wanted"))
    )
    lines = (
        dealt.join(by_doc, "doc_id")
        .select("row_key", F.explode("wanted").alias("w"), F.expr(r"split(text, '\n') AS lines"), F.expr(f"{_OTHER_SPACE} AS other_space"))
        .where("row_key = w.row_key")
        .select("w.*", "other_space", F.expr(f"lines[CAST(pmod(w.position, {LINES}L) AS int)] AS line"))
        .select("position", "row_key", *flags, F.expr(f"split({_LINE}, ' ') AS words"))
    )
    near = _near_removed(lines).select(F.col("position").alias("first"), "row_key", F.lit(True).alias("near"))
    gone = distinct.select("k1", "k2", "first", "last", "row_key").join(near, ["first", "row_key"], "left")
    gone = gone.where("first < last OR near").select("k1", "k2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    places = _lines(source).select("doc_id", "row_key", "line_no", "position", *_line_keys())
    removed = (
        places.join(gone, ["k1", "k2"])
        .where("near OR position > first")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("row_key", "line_no")).alias("removed"))
    )
    own = "array_distinct(transform(filter(removed, r -> r.row_key = row_key), r -> r.line_no)) AS removed"
    found = dealt.join(removed, "doc_id", "left").select(*columns.values(), "text", F.expr(own))
    kept = F.expr(r"""CASE WHEN size(removed) > 0 THEN array_join(transform(
        array_except(sequence(0, size(split(text, '\n')) - 1), removed), i -> split(text, '\n')[i]), '\n') ELSE text END""")
    result = found.select(
        *(kept.alias(c) if c == text else F.col(n).alias(c) for c, n in columns.items()),
        F.expr("coalesce(size(removed), 0)").alias(count),
    )
    return result.unionByName(documents.where(F.col(doc_id).isNull()).withColumn(count, F.lit(0)))
