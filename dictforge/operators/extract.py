"""Relational dictionary tables to one row per meaning, and to nested word records."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dictforge import schemas
from dictforge.config import Config
from dictforge.functions import text as T
from dictforge.operators.skew import MIN_HOT_ROWS, block_lists, fits_broadcast, hot_keys, lookup_join, salted_join
from dictforge.session import shuffles_removed
from dictforge.sources.buckets import Bucketed

# Titles beyond this many are joined instead of looked up in a map inside the row.
MAP_ROWS = 5_000
# Meanings lie by word unless a word holds more than about this part of them.
WORD_SHARE = 256
# Sources up to this size are broadcast: beyond it the texts of all meanings pass one more exchange.
SOURCE_ROWS, SOURCE_BYTES = 400_000, 64 * 1024 * 1024


def word_columns(words: DataFrame) -> DataFrame:
    """Word metadata with the default language and the constant class."""
    return words.select(
        F.col("WordId").alias("word_ord"),
        "WordText",
        F.when(T.is_blank(F.col("Language")), "sa").otherwise(F.col("Language")).alias("WordLanguage"),
        "WordTextAlternate",
        "Syllables",
        F.lit("dictionary_entry").alias("TypeClass"),
    )


def join_tables(words: DataFrame, meanings: DataFrame, sources: DataFrame) -> DataFrame:
    """Meanings with their word and source columns.

    A word may hold any share of the meanings: the word side is small per key, so the join is from the
    meanings and its hot keys are salted. ``words_without_meanings`` gives the rest of the left join.
    """
    with_source = lookup_join(
        meanings.withColumnRenamed("WordId", "word_ord"), sources, "SourceId", "left", "MeaningId"
    )
    words = word_columns(words)
    if fits_broadcast(words):
        return with_source.join(F.broadcast(words), "word_ord")
    return salted_join(with_source, words, "word_ord", "inner", "MeaningId")


def lie_evenly(meanings: DataFrame) -> bool:
    """Whether no word holds more than about one in ``WORD_SHARE`` of the meanings, so that they may lie by word."""
    counted = meanings.where(F.col("MeaningId").isNotNull())
    with shuffles_removed(meanings.sparkSession):
        rows = counted.count()
        return not hot_keys(counted, "WordId", min(MIN_HOT_ROWS, max(2, rows // WORD_SHARE)))


def join_by_word(
    words: DataFrame, meanings: DataFrame, sources: DataFrame, attach: Callable[[DataFrame], DataFrame], only_attached: bool,
    cut: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``join_tables`` with the columns that ``attach`` gives to rows by ``MeaningId``; the rows lie by word, and their texts
    pass one exchange.

    What belongs to a meaning is found over ids alone and comes to its word among the meanings, where a window finds it: a join by word
    and meaning would not lie by word. ``only_attached`` leaves out meanings that ``attach`` leaves out; else they stay without these columns.
    ``cut`` adds columns to single rows before they go to their word.
    """
    named = meanings.withColumnRenamed("WordId", "word_ord").dropna(subset=["MeaningId", "word_ord"])
    ids = named.select("MeaningId", "word_ord").repartition("MeaningId").distinct()
    attached = attach(ids)
    given = [c for c in attached.columns if c not in ids.columns]
    # Ids to which nothing belongs need not come along.
    some = attached.where(reduce(or_, [F.col(c).isNotNull() for c in given], F.lit(only_attached)))
    small = fits_broadcast(sources, SOURCE_ROWS, SOURCE_BYTES)
    with_source = lookup_join(named, sources, "SourceId", "left", "MeaningId", small)
    with_source = cut(with_source) if cut else with_source
    both = with_source.withColumn("_own", F.lit(True)).unionByName(
        some.select("MeaningId", "word_ord", F.struct(*given).alias("_given")), allowMissingColumns=True
    )
    found = F.first("_given", ignorenulls=True).over(Window.partitionBy("word_ord", "MeaningId"))
    # As many tasks as there are partitions: what a task sorts and cleans is much more than what it reads.
    tasks = int(meanings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = both.repartition(tasks, "word_ord").withColumn("_given", found).where("_own")
    if only_attached:
        rows = rows.where(F.col("_given").isNotNull())
    placed = rows.select(*with_source.columns, *[F.col(f"_given.{c}").alias(c) for c in given])
    return placed.join(word_columns(words), "word_ord")


def words_without_meanings(words: DataFrame, meanings: DataFrame) -> DataFrame:
    used = meanings.where(F.col("MeaningId").isNotNull()).select("WordId").distinct()
    return word_columns(words.join(used, "WordId", "left_anti"))


def title_dimension(titles: DataFrame) -> DataFrame:
    """One title per code: rows missing either key are dropped, the last by ``ord`` wins.

    Without ``ord`` the largest title wins, so the choice never depends on the layout of the rows.
    """
    named = titles.dropna(subset=["Code", "Title"])
    last = F.max_by("Title", F.struct("ord", "Title")) if "ord" in titles.columns else F.max("Title")
    return named.groupBy("Code").agg(last.alias("Title"))


def with_titles(df: DataFrame, titles: DataFrame, refs: str = "refs", row_id: str = "MeaningId") -> DataFrame:
    """Add the title of each reference of a row; unmatched codes keep a null title.

    ``titles`` may repeat codes (see ``title_dimension``). A row without references keeps its empty list.
    """
    titles = title_dimension(titles)

    def titled(ref: Column, title: Column) -> Column:
        return F.struct(
            ref["InternalCode"].alias("InternalCode"),
            ref["ReferenceCode"].alias("ReferenceCode"),
            title.alias("Title"),
        )

    if fits_broadcast(titles, MAP_ROWS):
        entries = F.map_from_entries(F.collect_list(F.struct("Code", "Title")))
        lookup = titles.agg(entries.alias("titles")).scalar()
        return df.withColumn("_titles", lookup).withColumn(
            refs, F.transform(refs, lambda r: titled(r, F.try_element_at("_titles", r["InternalCode"])))
        ).drop("_titles")
    exploded = df.select(row_id, F.posexplode(refs).alias("pos", "ref")).withColumn(
        "Code", F.col("ref.InternalCode")
    )
    joined = lookup_join(exploded, titles, "Code", "left", row_id)
    gathered = joined.groupBy(row_id).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", titled(F.col("ref"), F.col("Title")).alias("ref")))),
            lambda x: x["ref"],
        ).alias(refs)
    )
    kept = df.withColumnRenamed(refs, "_untitled").join(gathered, row_id, "left")
    none = F.array().cast(gathered.schema[refs].dataType)
    return kept.withColumn(refs, F.when(F.col("_untitled").isNotNull(), F.coalesce(refs, none))).drop("_untitled")


def clean_meanings(
    joined: DataFrame, titles: DataFrame, cfg: Config, passed: tuple[str, ...] = ()
) -> DataFrame:
    """Plain text, references and ordering columns of each joined meaning; ``passed`` columns stay.

    ``meaning_ord`` is the extraction order inside a word: source, sequence, id.
    """
    raw = F.col("MeaningText")
    rows = joined.where(F.col("MeaningId").isNotNull()).withColumns(
        {
            "refs": T.reference_codes(raw, cfg.reference_regex),
            "clean": T.html_to_text(raw),
            "meaning_ord": F.struct(
                F.col("SourceShortText").alias("source"),
                F.col("SeqNo").cast("int").alias("seq"),
                F.col("MeaningId").alias("id"),
            ),
        }
    )
    has_source = ~T.is_blank(F.col("SourceShortText")) | ~T.is_blank(F.col("SourceLongText"))
    languages = F.when(~T.is_blank(F.col("SourceLanguages")), F.col("SourceLanguages"))
    source = F.struct(
        F.col("SourceShortText").alias("ShortText"),
        F.col("SourceLongText").alias("LongText"),
        languages.alias("Languages"),
    )
    return with_titles(rows, titles).select(
        "word_ord", "WordText", "WordLanguage", "WordTextAlternate", "Syllables",
        "MeaningId", "meaning_ord",
        F.col("clean").alias("text"),
        "Type", "TypeGender",
        F.col("SeqNo").cast("int").cast("string").alias("seq_no"),
        F.when(~T.is_blank(F.col("Language")), F.col("Language")).alias("Language"),
        "refs",
        F.when(has_source, source).alias("source"),
        T.text_or_empty(F.col("SourceShortText")).alias("source_short"),
        # Cleaning never lengthens a text, so this bounds the number of its parts without cleaning it.
        F.length(T.text_or_empty(F.col("MeaningText"))).alias("raw_chars"),
        *passed,
    )


def extension_flags(extensions: DataFrame) -> DataFrame:
    """Meanings that have extensions. ``distinct`` combines before its shuffle."""
    return extensions.select("MeaningId").where(F.col("MeaningId").isNotNull()).distinct()


def extension_lists(extensions: DataFrame, cfg: Config, hot: list | None = None) -> DataFrame:
    """Extensions per meaning, ordered; very large lists continue over several rows. ``hot`` as in ``block_lists``."""
    names = ["ExtensionType", "WordList", "Details"]
    chars = sum((F.coalesce(F.length(name), F.lit(0)) for name in names), F.lit(0))
    return block_lists(
        extensions, "MeaningId", names, None, cfg.items_per_row, max_chars=cfg.chars_per_row, chars=chars, hot=hot
    )


def link_lists(links: DataFrame, cfg: Config, hot: list | None = None) -> DataFrame:
    """Cleaned links per meaning, lists of blanks dropped. ``hot`` as in ``block_lists``."""
    some = links.where(T.has_list_items(F.col("WordList")))
    cleaned = some.select("MeaningId", T.clean_word_list(F.col("WordList")).alias("WordList"))
    return block_lists(
        cleaned, "MeaningId", ["WordList"], None, cfg.items_per_row, max_chars=cfg.chars_per_row,
        chars=F.length("WordList"), hot=hot,
    )


def first_and_more(lists: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The row of each meaning that goes into its own item, and the rows that continue it."""
    lists = lists.withColumnRenamed("items", name)
    return lists.where("block = 0").drop("block"), lists.where("block > 0")


def joined_lists(lists: DataFrame, name: str, text: Callable[[Column], Column], between: str) -> DataFrame:
    """The whole list of each meaning as one text ``name``, those of all its blocks in their order.

    The blocks of a meaning lie together as ``block_lists`` leaves them, so only those of hot keys pass an exchange.
    """
    blocks = lists.select("MeaningId", F.struct("block", F.array_join(F.transform("items", text), between).alias("text")).alias("own"))
    whole = F.transform(F.array_sort(F.collect_list("own")), lambda own: own["text"])
    return blocks.groupBy("MeaningId").agg(F.array_join(whole, between).alias(name))


def attach_lists(
    rows: DataFrame, ext: DataFrame, links: DataFrame, texts: dict[str, tuple[Callable[[Column], Column], str]] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Give each meaning its extensions and links; the second frame holds what continues elsewhere.

    With ``texts``, the text of an item and what stands between two for ``Extensions`` and ``ExtensionLinks``, each meaning gets
    its whole lists as texts and nothing continues.
    """
    if texts:
        for name, lists in (("Extensions", ext), ("ExtensionLinks", links)):
            rows = rows.join(joined_lists(lists, name, *texts[name]), "MeaningId", "left")
        return rows, rows.limit(0)
    first_ext, more_ext = first_and_more(ext, "Extensions")
    first_links, more_links = first_and_more(links, "ExtensionLinks")
    attached = rows.join(first_ext, "MeaningId", "left").join(first_links, "MeaningId", "left")
    return attached, more_ext.unionByName(more_links, allowMissingColumns=True)


def attach_bucketed(
    tables: dict[str, Bucketed], part: str, cfg: Config,
    texts: dict[str, tuple[Callable[[Column], Column], str]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``attach_lists`` over one part, ``usual`` or ``hot``, of tables bucketed by meaning."""
    meanings, extensions, links = (getattr(tables[n], part) for n in ("meanings", "extensions", "extension_links"))
    # Which keys are hot was found when the tables were written.
    hot = [] if part == "usual" else list(tables["meanings"].hot_keys)
    return attach_lists(meanings, extension_lists(extensions, cfg, hot), link_lists(links, cfg, hot), texts)


def content_item() -> Column:
    """The nested form of one meaning; fields that do not apply are null and left out when written."""
    return F.struct(
        F.col("text").alias("MeaningText"),
        "Type", "TypeGender",
        F.col("seq_no").alias("SeqNo"),
        "Language",
        F.when(F.size("refs") > 0, F.col("refs")).alias("References"),
        F.col("source").alias("Source"),
        "Extensions", "ExtensionLinks", "ManagedType", "part_index", "total_parts",
        "MeaningId", F.when(F.col("cont") >= 0, F.col("cont")).alias("cont"),
    ).cast(schemas.CONTENT_ITEM)


def nest_words(rows: DataFrame, order: list[str], word_table: DataFrame, cfg: Config) -> DataFrame:
    """One record per word, words without meanings included.

    A record holds at most ``items_per_row`` meanings and about ``chars_per_row`` characters; a larger word
    continues in further records of the same metadata, ordered by ``block`` (0, 1, ...). Items carry the
    id of their meaning; ``cont`` marks an item that continues the lists of that meaning.
    """
    missing = {
        "ManagedType": "array<string>", "part_index": "int", "total_parts": "int", "MeaningId": "long", "cont": "long",
    }
    rows = rows.withColumns(
        {name: F.lit(None).cast(kind) for name, kind in missing.items() if name not in rows.columns}
    )
    lists = block_lists(rows, "word_ord", order, content_item(), cfg.items_per_row, "content", cfg.chars_per_row)
    metadata = F.struct(
        F.col("WordLanguage").alias("Language"), "WordText", "WordTextAlternate", "Syllables", "TypeClass"
    )
    empty = F.array().cast(f"array<{schemas.CONTENT_ITEM}>")
    # The metadata come to the blocks: those of a word with very many stay spread.
    filled = lists.join(word_table, "word_ord")
    without = word_table.join(lists.where("block = 0").select("word_ord"), "word_ord", "left_anti")
    both = filled.unionByName(without, allowMissingColumns=True)
    return both.select(
        "word_ord",
        F.coalesce("block", F.lit(0).cast("long")).alias("block"),
        metadata.alias("metadata"),
        F.coalesce("content", empty).alias("content"),
    )


def reference_audit(rows: DataFrame, titles: DataFrame, refs: str = "refs") -> DataFrame:
    """Every code met with its title, or ``NOT FOUND``."""
    codes = rows.select(F.explode(refs).alias("ref")).select(F.col("ref.InternalCode").alias("Code")).distinct()
    return (
        lookup_join(codes, title_dimension(titles), "Code", "left")
        .select("Code", F.coalesce("Title", F.lit("NOT FOUND")).alias("Mapping"))
        .orderBy("Code")
    )
