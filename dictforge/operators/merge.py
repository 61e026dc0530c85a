"""Long meanings split, short meanings of one source packed and merged, types mapped to tags."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dictforge.config import Config
from dictforge.functions import text as T
from dictforge.operators.ordered import by_group_size, with_packs, with_packs_of_large_groups
from dictforge.operators.skew import fits_broadcast, lookup_join

# Meanings of one group that may meet in a row; their texts are already cut to the split limit.
GROUP_ROWS = 1_000
# The parts of a long text, where they come with the rows.
PARTS = "_parts"

_BREAKS = re.compile("[।\n.]")


def _cut(text: str, limit: int) -> list[str]:
    """Parts of a long text: as many whole segments as fit, segments beyond the limit in slices."""
    ends = [m.end() for m in _BREAKS.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    parts = []
    start = 0
    while start < len(text):
        fitting = bisect_right(ends, start + limit)
        if fitting and ends[fitting - 1] > start:
            stop = ends[fitting - 1]
            parts.append(text[start:stop].strip())
        else:
            stop = ends[fitting]
            parts.extend(text[at : min(at + limit, stop)].strip() for at in range(start, stop, limit))
        start = stop
    return parts


def split_parts(c: Column, limit: int) -> Column:
    """Parts of texts longer than ``limit``; null for the others, which never leave the JVM."""

    @F.pandas_udf("array<string>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda text: _cut(text, limit), na_action="ignore")

    stripped = T.strip(T.text_or_empty(c))
    return cut(F.when(F.length(stripped) > limit, stripped))


def split_meanings(
    rows: DataFrame, limit: int, text: str = "text", only_first: tuple[str, ...] = ("refs", "Extensions", "ExtensionLinks")
) -> DataFrame:
    """One row per part. Parts after the first lose the heavy fields; empty parts are counted, not kept.

    Rows that have ``PARTS`` are not cut again.
    """
    cut = rows if PARTS in rows.columns else rows.withColumn(PARTS, split_parts(F.col(text), limit))
    parted = cut.select(
        "*",
        F.posexplode(F.coalesce("_parts", F.array(F.lit(None).cast("string")))).alias("_at", "_part"),
    )
    kept = parted.where(F.col("_parts").isNull() | (F.col("_part") != ""))
    several = F.size("_parts") > 1
    isolated = {
        c: F.when(F.col("_at") == 0, F.col(c)) for c in only_first if c in rows.columns
    }
    return kept.withColumns(
        {
            **isolated,
            text: F.when(F.col("_parts").isNull(), F.col(text)).otherwise(F.col("_part")),
            "part_index": F.when(several, F.col("_at") + 1),
            "total_parts": F.when(several, F.size("_parts")),
            "part_ord": F.col("_at"),
        }
    ).drop("_parts", "_at", "_part")


def is_unmerged(source_short: Column, has_ext: Column, marker: str) -> Column:
    """Meanings that keep their own record: those of the marked source and those with extensions."""
    return F.contains(T.text_or_empty(source_short), F.lit(marker)) | F.coalesce(has_ext, F.lit(False))


def with_managed_types(
    rows: DataFrame, labels: DataFrame, cfg: Config, small: bool | None = None
) -> DataFrame:
    """Tags of each row from the ``(kind, raw, label)`` dimension."""
    small = fits_broadcast(labels) if small is None else small
    tagged = rows
    for kind, column in (("type", "Type"), ("gender", "TypeGender")):
        dim = labels.where(F.col("kind") == kind).select(
            F.col("raw").alias(f"_{kind}"),
            # Labels are cut here, once per label and not once per meaning.
            T.label_tokens(F.col("label"), cfg.split_regex, cfg.exclude_keywords).alias(f"_{kind}_tokens"),
        )
        tagged = tagged.withColumn(f"_{kind}", T.strip(T.text_or_empty(F.col(column))))
        tagged = lookup_join(tagged, dim, f"_{kind}", small=small)
    return tagged.withColumn(
        "ManagedType", T.managed_types(F.col("_type_tokens"), F.col("_gender_tokens"))
    ).drop("_type", "_gender", "_type_tokens", "_gender_tokens")


def pack_meanings(
    rows: DataFrame,
    cfg: Config,
    keys: tuple[str, ...] = ("word_ord", "source_short"),
    census: DataFrame | None = None,
) -> DataFrame:
    """Number the packs of each group in sequence order; ties keep the order of ``meaning_ord``."""
    sequenced = rows.withColumn("seq_sort", T.sequence_key(F.col("seq_no"), cfg.seqno_regex))
    return with_packs(
        sequenced,
        list(keys),
        ["seq_sort", "meaning_ord", "part_ord"],
        F.length(T.strip(T.text_or_empty(F.col("text")))),
        cfg.meanings_per_record,
        cfg.max_chars_per_split,
        census,
    )


def merged_line(type_col: Column, gender_col: Column, text: Column) -> Column:
    """``type gender text`` on one line; ``text`` has its entities undone."""
    pieces = F.concat_ws(
        " ", T.strip(T.text_or_empty(type_col)), T.strip(T.text_or_empty(gender_col)), T.normalize_unescaped(text)
    )
    return T.collapse_space(T.strip(pieces))


_ORDER = ("seq_sort", "meaning_ord", "part_ord")
_FIELDS = ("Type", "TypeGender", "text", "seq_no", "ManagedType", "refs", "ExtensionLinks", "part_index", "total_parts")


def _pack_bounds(items: Column, cfg: Config) -> Column:
    """Position of the first item of each pack of one group, by a fold over its items."""

    def step(state: Column, item: Column) -> Column:
        opens = (
            (F.size(state["starts"]) == 0)
            | (state["count"] >= cfg.meanings_per_record)
            | (state["chars"] + item["chars"] > cfg.max_chars_per_split)
        )
        return F.struct(
            F.when(opens, F.array_append(state["starts"], state["at"])).otherwise(state["starts"]).alias("starts"),
            F.when(opens, F.lit(1)).otherwise(state["count"] + 1).alias("count"),
            F.when(opens, item["chars"]).otherwise(state["chars"] + item["chars"]).alias("chars"),
            (state["at"] + 1).alias("at"),
        )

    begin = F.struct(
        F.array().cast("array<int>").alias("starts"), F.lit(0).alias("count"),
        F.lit(0).alias("chars"), F.lit(1).alias("at"),
    )
    return F.aggregate(items, begin, step, lambda state: state["starts"])


def _packs_in_rows(rows: DataFrame, item: Column, cfg: Config, keys: tuple[str, ...]) -> DataFrame:
    """Packs of groups that fit one row: one shuffle on the group, everything else inside the row."""
    grouped = rows.groupBy(*keys).agg(
        F.array_sort(F.collect_list(item)).alias("group"), F.min("meaning_ord").alias("group_first")
    )
    bounds = F.when(F.size("group") == 1, F.array(F.lit(1))).otherwise(_pack_bounds(F.col("group"), cfg))
    bounded = grouped.withColumn("starts", bounds)

    def cut(start: Column, at: Column) -> Column:
        after = F.coalesce(F.get("starts", at + 1), F.size("group") + 1)
        return F.slice("group", start, after - start)

    return bounded.select(
        *keys,
        F.size("group").cast("long").alias("group_items"),
        F.size("starts").cast("long").alias("group_packs"),
        "group_first",
        F.posexplode(F.transform("starts", cut)).alias("pack", "items"),
    )


def _packs_across_rows(rows: DataFrame, item: Column, cfg: Config, keys: tuple[str, ...]) -> DataFrame:
    """Packs of groups of any size; only the members of one pack meet in a row."""
    packed = with_packs_of_large_groups(
        rows, list(keys), list(_ORDER), F.col("chars"), cfg.meanings_per_record, cfg.max_chars_per_split
    )
    packs = packed.groupBy(*keys, "group_items", "group_packs", F.col("pack").cast("int").alias("pack")).agg(
        F.array_sort(F.collect_list(item)).alias("items")
    )
    firsts = rows.groupBy(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)]).agg(
        F.min("meaning_ord").alias("group_first")
    )
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_g{i}"))
    return packs.join(firsts, same).drop(*[f"_g{i}" for i in range(len(keys))])


def merge_groups(
    rows: DataFrame,
    cfg: Config,
    keys: tuple[str, ...] = ("word_ord", "source_short"),
    carried: tuple[str, ...] = (),
    census: DataFrame | None = None,
    local_rows: int = GROUP_ROWS,
    most: DataFrame | None = None,
) -> DataFrame:
    """Pack the meanings of each group in sequence order and merge every pack into one row.

    A group of a single meaning passes as it is. ``carried`` columns come from the first row of a pack.
    Texts are at most ``max_chars_per_split`` long here, so a group of ``local_rows`` fits a row; larger
    groups are spread over range partitions.
    """
    text = T.text_or_empty(F.col("text"))
    sized = rows.withColumns(
        {
            "seq_sort": T.sequence_key(F.col("seq_no"), cfg.seqno_regex),
            "chars": F.length(T.strip(text)),
            "unescaped": T.unescaped(text),
        }
    )
    # The leading fields of an item are a total order, so sorting the structs sorts the group.
    item = F.struct(*_ORDER, "chars", "unescaped", *_FIELDS, *carried)
    usual, large = by_group_size(sized, list(keys), census, local_rows, most)
    gathered = _packs_in_rows(usual, item, cfg, keys)
    if large is not None:
        gathered = gathered.unionByName(_packs_across_rows(large, item, cfg, keys))
    return _merged_rows(gathered.withColumn("first", F.get("items", F.lit(0))), rows, cfg, keys, carried)


def _merged_rows(
    gathered: DataFrame, rows: DataFrame, cfg: Config, keys: tuple[str, ...], carried: tuple[str, ...]
) -> DataFrame:
    several = F.col("group_items") > 1

    def unless_single(field: str, merged: Column) -> Column:
        return F.when(several, merged).otherwise(F.col(f"first.{field}")).alias(field)

    def united(field: str) -> Column:
        lists = F.transform("items", lambda i: F.coalesce(i[field], F.array().cast(_type_of(rows, field))))
        distinct = F.array_distinct(F.flatten(lists))
        use_union = (F.size(distinct) > 0) & (F.lit(cfg.keep_all_citations) | (F.col("pack") == 0))
        return F.when(use_union, distinct).otherwise(F.col(f"first.{field}"))

    def line(i: Column) -> Column:
        return merged_line(i["Type"], i["TypeGender"], F.coalesce(i["unescaped"], i["text"], F.lit("")))

    def numbered(i: Column) -> Column:
        return F.when(T.strip(T.text_or_empty(i["seq_no"])) != "", i["seq_no"])

    tags = F.array_sort(F.array_distinct(F.flatten(F.transform("items", lambda i: i["ManagedType"]))))
    parted = F.col("group_packs") > 1
    return gathered.select(
        *keys,
        *[F.col(f"first.{c}").alias(c) for c in ("meaning_ord", "part_ord", *carried)],
        unless_single("text", F.array_join(F.transform("items", line), "\n")),
        unless_single("seq_no", F.array_join(F.transform("items", numbered), ",")),
        unless_single("Type", F.lit("")),
        unless_single("TypeGender", F.lit("")),
        unless_single("ManagedType", tags),
        unless_single("refs", united("refs")),
        unless_single("ExtensionLinks", united("ExtensionLinks")),
        F.when(parted, F.col("pack") + 1).otherwise(F.col("first.part_index")).alias("part_index"),
        F.when(parted, F.col("group_packs").cast("int")).otherwise(F.col("first.total_parts")).alias("total_parts"),
        F.col("pack").cast("long").alias("pack"),
        "group_first",
        *([_link_members(cfg).alias("link_members")] if "MeaningId" in carried else []),
    )


def _link_members(cfg: Config) -> Column:
    """Meanings whose links a merged row shows; at most the members of one pack."""
    whole = F.filter("items", lambda i: i["part_ord"] == 0)
    shown = F.when(F.lit(cfg.keep_all_citations) | (F.col("pack") == 0), whole).otherwise(
        F.filter(F.slice("items", 1, 1), lambda i: i["part_ord"] == 0)
    )
    return F.transform(shown, lambda i: i["MeaningId"])


def _type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def merge_content(
    rows: DataFrame,
    labels: DataFrame,
    cfg: Config,
    word_cols: tuple[str, ...] = (),
    extension_cols: tuple[str, ...] = (),
    most: DataFrame | None = None,
) -> DataFrame:
    """Split, tag, route, pack and merge the meanings of all words, in one pass over ``rows``.

    ``rows`` needs word_ord, meaning_ord, source_short, text, Type, TypeGender, seq_no, refs,
    ExtensionLinks, has_ext and the ``word_cols``; ``extension_cols`` belong to the first part of unmerged
    meanings and are null elsewhere. A part of an unmerged meaning is a group of its own, so unmerged and
    merged rows share one shuffle. The result adds the position of each row in its word as ``content_ord``:
    sequence first, then unmerged rows, then groups by their first appearance. ``most`` as in ``by_group_size``. Rows that
    lie by word already pass no exchange here.
    """
    unmerged = is_unmerged(F.col("source_short"), F.col("has_ext"), cfg.unmerged_source)
    if "raw_chars" not in rows.columns:
        rows = rows.withColumn("raw_chars", F.length(T.text_or_empty(F.col("text"))))
    routed = rows.withColumn("own", F.when(unmerged, F.col("meaning_ord")))
    # The only second look at the input, and a narrow one: which groups are too large for a row.
    census = routed.where(F.col("own").isNull()).select(
        "word_ord", "source_short", "own", F.lit(None).cast("int").alias("own_part"),
        (F.lit(1) + F.floor(F.col("raw_chars") / cfg.max_chars_per_split)).alias("weight"),
    )
    parts = with_managed_types(split_meanings(routed, cfg.max_chars_per_split), labels, cfg)
    leading = F.col("own").isNotNull() & (F.col("part_ord") == 0)
    parts = parts.withColumns(
        {
            "own_part": F.when(F.col("own").isNotNull(), F.col("part_ord")),
            **{c: F.when(leading, F.col(c)) for c in extension_cols},
        }
    )
    carried = tuple(
        c for c in rows.columns if c in word_cols or c in extension_cols or c in ("Language", "source", "MeaningId")
    )
    merged = merge_groups(
        parts, cfg, keys=("word_ord", "source_short", "own", "own_part"), carried=carried, census=census, most=most
    )
    emit = F.when(F.col("own").isNull(), 1).otherwise(0)
    return merged.withColumn(
        "content_ord",
        F.struct(
            T.sequence_key(F.col("seq_no"), cfg.seqno_regex).alias("seq"),
            emit.alias("emit"),
            F.when(emit == 1, F.col("group_first")).alias("group"),
            "pack", "meaning_ord", "part_ord",
        ),
    ).drop("own", "own_part", "group_first", "pack")
