"""Discovery, pairing and reading of tab-separated files with a two-line header.

A file becomes one row first: its lines are split, its header is read and its columns are located once per file,
then the lines are exploded in place. Row numbers come from the position in the file and nothing is shuffled.
Files above ``MAX_WHOLE_FILE`` are read line by line in splits instead, see ``split_lines``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windrow import presets
from windrow.functions.clock import file_time
from windrow.functions.escapes import decode_escapes
from windrow.functions.numeric import to_number
from windrow.operators.fill import dedupe_last, row_index
from windrow.session import landed, matching

MAX_WHOLE_FILE = 64 * 1024 * 1024
NUL = "\x00"


def _any_case(extension: str) -> str:
    """Glob for an extension in upper or lower case."""
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension)


def same_path(path: Column) -> Column:
    """Spelling of a path that does not depend on the reader (``file:/x`` and ``file:///x``)."""
    return F.regexp_replace(path, ":/+", ":/")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def aligned_periods(start: dt.datetime, end: dt.datetime) -> list[tuple[dt.datetime, str]]:
    """Whole years, months, days and hours that cover ``start`` to ``end`` (excluded), as few as possible: (begin, kind)."""
    at, out = start.replace(minute=0, second=0, microsecond=0), []
    while at < end:
        year, month = at.replace(year=at.year + 1, month=1, day=1, hour=0), (at.replace(day=1, hour=0) + dt.timedelta(32)).replace(day=1)
        steps = [("year", year, at.month == at.day == 1 and at.hour == 0), ("month", month, at.day == 1 and at.hour == 0)]
        steps += [("day", at.replace(hour=0) + dt.timedelta(1), at.hour == 0), ("hour", at + dt.timedelta(hours=1), True)]
        kind, after = next((k, after) for k, after, aligned in steps if aligned and (after <= end or k == "hour"))
        out.append((at, kind))
        at = after
    return out


#: What the names of files of one period have in common, and the digits that they do not.
PERIOD_NAMES = {"year": ("%y", 4, 2), "month": ("%y%m", 2, 2), "day": ("%y%m%d", 0, 2), "hour": ("%y%m%d_%H", 0, 0)}


def name_glob(extension: str, span: tuple[dt.datetime, dt.datetime] | None = None) -> str:
    """Glob for an extension in upper or lower case, of files that start within the span if one is given."""
    if span is None:
        return _any_case(extension)
    stamps = []
    for begin, kind in aligned_periods(*span):
        form, days, hours = PERIOD_NAMES[kind]
        stamps.append(begin.strftime(form) + "[0-9]" * days + ("_" + "[0-9]" * hours if hours else ""))
    return "*{" + ",".join(stamps) + "}" + _any_case(extension)[1:]


def time_roots(spark: SparkSession, roots: Sequence[str], layout: str, span: tuple[dt.datetime, dt.datetime]) -> list[str]:
    """The existing folders below ``roots`` that ``layout`` (such as ``%Y/%m``) names for the days of a span."""
    first = span[0].replace(hour=0, minute=0, second=0, microsecond=0)
    days = (first + dt.timedelta(n) for n in range((span[1] - first).days + 1))
    named = dict.fromkeys(day.strftime(layout) for day in days if day < span[1])
    return [found for root in roots for name in named for found in matching(spark, f"{root.rstrip('/')}/{name}")]


def find_files(
    spark: SparkSession, root: str | Sequence[str], extension: str,
    start: dt.datetime | None = None, end: dt.datetime | None = None, layout: str | None = None, fmt: str = "binaryFile",
) -> DataFrame:
    """The files of a kind below one or several folders. They are listed when this is called, and not again.

    A range of time (``end`` excluded) becomes a glob over the names, so that no other file is in the listing. With
    ``layout``, the pattern of the folders of a day below each root, only folders in range are visited. Spark lists
    more than 32 folders in parallel.
    """
    roots = [root] if isinstance(root, str) else list(root)
    span = None if start is None and end is None else (start or dt.datetime(1969, 1, 1), end or dt.datetime(2069, 1, 1))
    if span and layout:
        roots = time_roots(spark, roots, layout, span)
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true").option("pathGlobFilter", name_glob(extension, span))
    if not roots or (span and span[0] >= span[1]):
        kinds = "path string, modificationTime timestamp, length bigint, content binary" if fmt == "binaryFile" else "value string"
        metadata = "_metadata struct<file_path: string, file_size: bigint, file_block_start: bigint>"
        return spark.createDataFrame([], f"{kinds}, {metadata}")
    return reader.load(roots)


def listing(found: DataFrame) -> DataFrame:
    """Found files as (name, stem, path, length, modified, uri). Only the listing is read, not the content."""
    listed = found.select(
        same_path(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modified"), F.col("_metadata.file_path").alias("uri")
    )
    named = listed.withColumn("name", basename(F.col("path"))).withColumn("stem", stem(F.col("name")))
    return named.select("name", "stem", "path", "length", "modified", "uri")


def list_files(spark: SparkSession, root: str | Sequence[str], extension: str, **span) -> DataFrame:
    """All files below ``root`` as (name, stem, path, length, modified, uri)."""
    return listing(find_files(spark, root, extension, **span))


def discover_files(spark: SparkSession, root: str, extension: str) -> DataFrame:
    """The listing without doubles: of several files with one name the one with the last path counts."""
    return newest(list_files(spark, root, extension))


def newest(listed: DataFrame) -> DataFrame:
    return dedupe_last(listed, ["stem"], ["path"])


def pair_files(left: DataFrame, right: DataFrame, key: str = "stem") -> DataFrame:
    """Partners with the same key; files without one drop out."""
    return left.join(right, key, "inner")


def discover_pairs(spark: SparkSession, root: str, raw: str = "raw", aux: str = "aux") -> DataFrame:
    """File pairs with their start time, as (file_id, start_ts) and path, length, time of change and URI of both sides.

    Files whose names hold no start time drop out, see ``unusable``.
    """
    return pairs_of(list_files(spark, root, raw), list_files(spark, root, aux), raw)


def pairs_of(raw: DataFrame, aux: DataFrame, extension: str = "raw") -> DataFrame:
    """The pairs in two listings."""
    facts = {"path": "path", "length": "len", "modified": "time", "uri": "uri"}
    sides = [
        newest(listed).select("stem", *[F.col(c).alias(f"{side}_{short}") for c, short in facts.items() if c in listed.columns])
        for side, listed in (("raw", raw), ("aux", aux))
    ]
    named = pair_files(*sides).withColumn("file_id", file_id_of(F.col("stem"), extension))
    timed = named.withColumn("start_ts", file_time(F.col("file_id"), presets.YEAR_PIVOT))
    rest = [c for c in timed.columns if c not in ("stem", "file_id", "start_ts")]
    return timed.where("start_ts is not null").select("file_id", "start_ts", *rest)


def unusable(raw: DataFrame, aux: DataFrame, extension: str = "raw") -> DataFrame:
    """Listed files that no pair uses, with the ``reason``."""
    sides = {"raw": raw, "aux": aux}
    out = []
    for side, listed in sides.items():
        (other,) = [x for s, x in sides.items() if s != side]
        used = newest(listed).select("path", F.lit(True).alias("_new"))
        partner = other.select("stem").distinct().withColumn("_partner", F.lit(True))
        marked = listed.join(used, "path", "left").join(partner, "stem", "left")
        reason = (
            F.when(F.col("_new").isNull(), "a file of this name with a later path")
            .when(F.col("_partner").isNull(), "no partner")
            .when(file_time(file_id_of(F.col("stem"), extension), presets.YEAR_PIVOT).isNull(), "no start time in its name")
        )
        out.append(marked.withColumn("reason", reason).where("reason is not null").select("path", "reason"))
    return out[0].unionByName(out[1])


def file_id_of(stem_text: Column, extension: str = "raw") -> Column:
    """Name of the pair: that of its fast file."""
    return F.concat(stem_text, F.lit(f".{extension}"))


def unpaired(listed: DataFrame, pairs: DataFrame, path: str) -> DataFrame:
    """Listed files that no pair uses: without partner, without start time, or superseded by a file of that name."""
    return listed.select("path").join(pairs.select(F.col(path).alias("path")), "path", "left_anti")


def clean_text(text: Column) -> Column:
    """Text without NUL bytes."""
    return F.replace(text, F.lit(NUL), F.lit(""))


def repair_mu(text: Column) -> Column:
    """Micro signs that were written as UTF-8 but decoded byte by byte."""
    return F.replace(text, F.lit("Âµ"), F.lit("µ"))


def physical_lines(text: Column) -> Column:
    """Lines end with LF, CR LF or a lone CR, as in Spark's text reader."""
    return F.split(text, r"\r\n|\r|\n")


def is_data(line: Column, sep: str = "\t") -> Column:
    """Blank lines do not count as rows, but a line of bare separators does."""
    filled = F.trim(line) != ""
    return filled if sep == " " else filled | F.contains(line, F.lit(sep))


def header_cells(names: Column, units: Column, sep: str = "\t") -> Column:
    """Header of a file as an array of (name, unit, pos), blank units replaced by ``[-]``."""
    name_cells, unit_cells = F.split(names, sep), F.split(units, sep)
    return F.transform(
        name_cells,
        lambda name, i: F.struct(
            name.alias("name"),
            F.when(F.trim(F.coalesce(F.get(unit_cells, i), F.lit(""))) == "", F.lit("[-]"))
            .otherwise(F.get(unit_cells, i))
            .alias("unit"),
            i.alias("pos"),
        ),
    )


def widen_header(header: Column, width: Column) -> Column:
    """Header with generated names for the columns that only the first data row has."""
    missing = F.greatest(width - F.size(header), F.lit(0))
    generated = F.transform(
        F.when(missing > 0, F.sequence(F.lit(1), missing)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            F.concat(F.lit("unknown_"), i.cast("string")).alias("name"),
            F.lit("[-unknown-]").alias("unit"),
            (F.size(header) + i - 1).alias("pos"),
        ),
    )
    return F.concat(header, generated)


def named_columns(header: Column) -> Column:
    """Header without columns that have no name of their own."""
    return F.filter(header, lambda h: (F.trim(h["name"]) != "") & ~F.contains(h["name"], F.lit("unknown")))


def decoded_lines(text: Column) -> tuple[Column, Column]:
    """Lines of a text with backslash escapes decoded, and which of them could not be (these stay as they are).

    An escaped line end ends a line too. Texts without a backslash are only split.
    """
    def pieces(line: Column) -> Column:
        known = decode_escapes(line)
        return F.transform(physical_lines(F.coalesce(known, line)), lambda x: F.struct(x.alias("line"), known.isNull().alias("bad")))

    spread = F.flatten(F.transform(physical_lines(text), pieces))
    escaped = F.contains(text, F.lit("\\"))
    return F.when(escaped, spread["line"]).otherwise(physical_lines(text)), F.when(escaped, spread["bad"])


def read_header(files: DataFrame, text: str, skip: int, header_rows: int = 2, sep: str = "\t", escapes: bool = False) -> DataFrame:
    """Add ``lines`` (data lines, blank ones left out) and the repaired ``header`` to one-row-per-file texts.

    With ``escapes``, backslash escapes are decoded, and ``undecoded`` has the places of data lines where that failed.
    """
    if header_rows not in (1, 2):
        raise ValueError("a header has one or two rows")
    clean = clean_text(F.col(text))
    all_lines, bad = decoded_lines(clean) if escapes else (physical_lines(clean), F.lit(None))
    with_lines = files.withColumn("_all", all_lines)
    units = F.get("_all", F.lit(skip + 1)) if header_rows == 2 else F.lit("")
    first_data = skip + header_rows + 1
    data = F.filter(F.slice("_all", first_data, F.greatest(F.size("_all"), F.lit(1))), lambda x: is_data(x, sep))
    undecoded = []
    if escapes:
        with_lines = with_lines.withColumn("_bad", bad)
        flags = F.slice(F.arrays_zip("_all", "_bad"), first_data, F.greatest(F.size("_all"), F.lit(1)))
        kept = F.filter(flags, lambda x: is_data(x["_all"], sep))
        places = F.filter(F.transform(kept, lambda x, i: F.when(x["_bad"], i)), lambda i: i.isNotNull())
        undecoded = [F.when(F.col("_bad").isNotNull(), places).otherwise(F.array().cast("array<int>")).alias("undecoded")]
    staged = with_lines.select(
        *[c for c in files.columns if c != text],
        header_cells(
            repair_mu(F.coalesce(F.get("_all", F.lit(skip)), F.lit(""))),
            repair_mu(F.coalesce(units, F.lit(""))),
            sep,
        ).alias("_names"),
        data.alias("lines"),
        *undecoded,
    )
    width = F.coalesce(F.size(F.split(F.get("lines", F.lit(0)), sep)), F.lit(0))
    return staged.withColumn("header", widen_header(F.col("_names"), F.when(F.size("lines") > 0, width).otherwise(0))).drop("_names")


#: Why a line is listed although its row is kept.
SURPLUS, UNDECODED = "more cells than the header", "an escape that cannot be decoded"


def explode_rows(files: DataFrame, sep: str = "\t", keep_lines: bool = False) -> DataFrame:
    """One row per data line with ``row_idx``, its ``cells`` and the flag ``malformed`` for surplus cells.

    A line with surplus cells keeps its place and its first cells. With ``keep_lines`` it is listed whole as ``line``,
    and so is a line whose escapes could not be decoded; ``fault`` says which of both it is.
    """
    kept = [c for c in files.columns if c not in ("lines", "undecoded")]
    placed = [*kept, "undecoded"] if "undecoded" in files.columns else kept
    rows = as_cells(files.select(*placed, F.posexplode("lines").alias("row_idx", "line")), sep)
    if not keep_lines:
        return rows.select(*[c for c in rows.columns if c not in ("line", "undecoded")])
    fault = F.when(F.array_contains("undecoded", F.col("row_idx").cast("int")), UNDECODED) if "undecoded" in files.columns else F.lit(None)
    return with_faults(rows, fault).drop("undecoded")


def with_faults(rows: DataFrame, fault: Column) -> DataFrame:
    found = rows.withColumn("fault", F.coalesce(fault.cast("string"), F.when(F.col("malformed"), SURPLUS)))
    return found.withColumn("line", F.when(F.col("fault").isNotNull(), F.col("line")))


def unquoted(cell: Column) -> Column:
    """A cell in double quotes without them; doubled quotes inside are single ones."""
    quoted = F.startswith(cell, F.lit('"')) & F.endswith(cell, F.lit('"')) & (F.length(cell) > 1)
    inner = F.substring(cell, F.lit(2), F.length(cell) - 2)
    return F.when(quoted, F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(cell)


def as_cells(rows: DataFrame, sep: str = "\t") -> DataFrame:
    """Cells of a text ``line``; needs the ``header`` of the file next to it. A quoted cell holds no separator."""
    parts = F.split("line", sep)
    bare = F.when(F.contains("line", F.lit('"')), F.transform(parts, unquoted)).otherwise(parts)
    cells = rows.withColumns({"cells": bare, "row_idx": F.col("row_idx").cast("bigint")})
    return cells.withColumn("malformed", F.size("cells") > F.size("header"))


def split_malformed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fit their header, and the rejects."""
    return rows.where(~F.col("malformed")), rows.where("malformed")


def locate_columns(files: DataFrame, mapping: Mapping[tuple[str, str], tuple[str, str]], helpers=()) -> DataFrame:
    """Add ``places``: where each wanted column sits in this file, and the positions of unknown ones.

    Done before the rows are exploded, so the header is searched once per file. If several header entries mean the
    same column the first one counts and ``ambiguous`` is set.
    """
    by_entry = F.create_map(
        *[F.lit(x) for (name, unit), (column, _) in mapping.items() for x in (f"{name}\t{unit}", column)]
    )
    wanted = list(dict.fromkeys(column for column, _ in mapping.values()))
    named = files.withColumn("_named", named_columns(F.col("header")))
    # The column that each header entry stands for, an empty text for unknown entries.
    meant = F.transform(
        "_named", lambda h: F.coalesce(F.element_at(by_entry, F.concat_ws("\t", h["name"], h["unit"])), F.lit(""))
    )
    located = named.withColumn("_meant", meant)
    place = {c: F.get("_named", (F.array_position("_meant", c) - 1).cast("int"))["pos"] for c in wanted}
    known = F.array_remove("_meant", "")
    others = F.filter("_named", lambda h, i: (F.get("_meant", i) == "") & ~h["name"].isin(*helpers, ""))
    keyed = F.transform(
        others, lambda h: F.struct(F.concat_ws(" ", h["name"], h["unit"]).alias("key"), h["pos"].alias("pos"))
    )
    # A repeated header entry keeps its first column.
    unknown = F.filter(keyed, lambda u, i: F.array_position(keyed["key"], u["key"]) == i + 1)
    return located.withColumns(
        {
            "places": F.struct(*[p.alias(c) for c, p in place.items()]),
            "unknown": unknown,
            "header_id": F.xxhash64(F.transform("header", lambda h: F.concat_ws("\t", h["name"], h["unit"]))),
            "ambiguous": F.size(F.array_distinct(known)) < F.size(known),
        }
    ).drop("_named", "_meant")


def canonical_columns(rows: DataFrame, text: tuple[str, ...] = (), numbers: tuple[str, ...] = ()) -> DataFrame:
    """Known columns by name from ``cells``; unknown ones, as numbers, in the map ``extras``."""
    out = [F.nullif(F.get("cells", F.col(f"places.{c}")), F.lit("")).alias(c) for c in text]
    out += [to_number(F.get("cells", F.col(f"places.{c}"))).alias(c) for c in numbers]
    extras = F.map_from_arrays(
        F.col("unknown.key"), F.transform("unknown.pos", lambda pos: to_number(F.get("cells", pos)))
    )
    rest = [c for c in rows.columns if c not in ("cells", "places", "unknown", "header")]
    named = [F.when(F.col("row_idx") == 0, F.col("header")).alias("header")] if "header_id" in rows.columns else []
    return rows.select(*rest, *named, *out, extras.alias("extras"))


def distinct_headers(rows: DataFrame) -> DataFrame:
    """One row per distinct header of files with data: header_id, its entries, how many files have it, and one of them."""
    firsts = rows.where("row_idx = 0")
    entries = F.transform("header", lambda h: F.struct(h["name"].alias("name"), h["unit"].alias("unit")))
    return firsts.groupBy("header_id").agg(F.first(entries).alias("entries"), F.count(F.lit(1)).alias("n_files"), F.min("file_id").alias("example"))


#: A name of an unknown column is a column of the series if this share of all files has it; and how many may be.
EXTRA_SHARE, MAX_EXTRA = 0.01, 200


def common_extras(rows: DataFrame, known: Sequence[str] = (), files_before: int = 0, share: float = EXTRA_SHARE, most: int = MAX_EXTRA) -> list[str]:
    """Names of the unknown columns that a share of the files have, the most frequent ones first, ``most`` at most.

    A name that is ``known`` to be a column counts if any file has it.

    All rows of a file have the same ones, so its first row tells. Damaged headers, which few files share, do not widen
    the series however many there are; their values are listed by ``rare_extras``.
    """
    firsts = rows.where("row_idx = 0")
    total = files_before + firsts.count()
    names = firsts.select(F.explode(F.map_keys("extras")).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    listed = F.col("name").isin(list(known)) if known else F.lit(False)
    best = names.where((F.col("n") >= share * total) | listed).orderBy(listed.desc(), F.desc("n"), "name").limit(max(most, len(known)))
    return [r["name"] for r in best.collect()]


def rare_extras(rows: DataFrame, side: str, columns: Sequence[str]) -> DataFrame:
    """Values of the unknown columns that are no columns of the series, one row each: side, file_id, row_idx, name, unit, value."""
    known = F.array(*[F.lit(c) for c in columns]).cast("array<string>")
    others = F.map_filter("extras", lambda k, v: v.isNotNull() & ~F.array_contains(known, k))
    listed = rows.select("file_id", "row_idx", F.explode(others).alias("key", "value"))
    unit = F.regexp_extract("key", r" (\[[^\[]*\]?)$", 1)
    name = F.when(unit == "", F.col("key")).otherwise(F.substring("key", F.lit(1), F.length("key") - F.length(unit) - 1))
    return listed.select(F.lit(side).alias("side"), "file_id", "row_idx", name.alias("name"), unit.alias("unit"), "value")


def chosen(found: DataFrame, uris: Sequence[str] | None) -> DataFrame:
    """Only files with one of the URIs; the scan is cut down to these files when it is planned."""
    return found if uris is None else found.where(F.col("_metadata.file_path").isin(list(uris)))


def read_texts(found: DataFrame, max_bytes: int = MAX_WHOLE_FILE) -> DataFrame:
    """Found files as (path, text); the size limit is pushed into the scan, larger files are not opened."""
    files = found.where(F.col("length") <= max_bytes)
    return files.select(same_path(F.col("path")).alias("path"), F.decode("content", "ISO-8859-1").alias("text"))


def split_lines(found: DataFrame, min_bytes: int) -> DataFrame:
    """Lines of the text files above ``min_bytes`` as (path, line_no, line), read in splits by many tasks.

    Each line is written once with its split and its place there; ids grow by one within a split, and the table holds
    what one attempt of each task saw. A line's number is its place plus the lines of the splits before it, which is
    one row per split.
    """
    lines = found.where(F.col("_metadata.file_size") > min_bytes).select(
        # The text source passes the bytes of a line through as they are.
        F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("line"),
        same_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("_split"),
    )
    numbered = landed(lines.withColumn("_id", F.monotonically_increasing_id()), "lines")
    splits = numbered.groupBy("path", "_split").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    earlier = Window.partitionBy("path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        "path", "_split", "_first", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_offset")
    )
    joined = numbered.join(landed(offsets, "splits"), ["path", "_split"])
    return joined.select("path", (F.col("_offset") + F.col("_id") - F.col("_first")).alias("line_no"), "line")


def large_file_rows(
    lines: DataFrame,
    describe: Callable[[DataFrame], DataFrame],
    mapping: Mapping[tuple[str, str], tuple[str, str]],
    helpers: tuple[str, ...],
    skip: int,
    header_rows: int,
    sep: str,
    escapes: bool = False,
) -> DataFrame:
    """What ``explode_rows`` gives, for numbered lines of files too large to be one row."""
    lines = lines.withColumns({"line": clean_text(F.col("line")), "_bad": F.lit(False), "_sub": F.lit(0)})
    if escapes:
        known = lines.withColumn("_known", decode_escapes(F.col("line"))).withColumn("_bad", F.col("_known").isNull())
        parts = F.posexplode(physical_lines(F.coalesce("_known", "line"))).alias("_sub", "line")
        lines = known.select(*[c for c in lines.columns if c not in ("line", "_sub")], parts)
    body = lines.where((F.col("line_no") >= skip + header_rows) & is_data(F.col("line"), sep))
    heads = lines.where((F.col("line_no") >= skip) & (F.col("line_no") < skip + header_rows) & (F.col("_sub") == 0))
    header = heads.groupBy("path").agg(
        F.max(F.when(F.col("line_no") == skip, F.col("line"))).alias("_n"),
        F.max(F.when(F.col("line_no") == skip + 1, F.col("line"))).alias("_u"),
    )
    widths = body.groupBy("path").agg(F.size(F.split(F.min_by("line", F.struct("line_no", "_sub")), sep)).alias("_width"))
    named = header_cells(repair_mu(F.col("_n")), repair_mu(F.coalesce("_u", F.lit(""))), sep)
    files = header.join(widths, "path").withColumn("header", widen_header(named, F.col("_width")))
    located = locate_columns(describe(files.select("path", "header")), mapping, helpers)
    cells = as_cells(body.join(located, "path").withColumn("row_idx", F.lit(None).cast("bigint")), sep)
    numbered = row_index(cells.drop("row_idx"), ["path"], ["line_no", "_sub"])
    return with_faults(numbered, F.when(F.col("_bad"), UNDECODED)).drop("line_no", "_sub", "_bad")


def read_rows(
    found: DataFrame,
    describe: Callable[[DataFrame], DataFrame],
    mapping: Mapping[tuple[str, str], tuple[str, str]],
    skip: int,
    header_rows: int = 2,
    helpers: tuple[str, ...] = (),
    sep: str = "\t",
    unwanted: DataFrame | None = None,
    large: DataFrame | None = None,
    max_bytes: int = MAX_WHOLE_FILE,
    escapes: bool = False,
) -> DataFrame:
    """Rows of the found files except the paths in ``unwanted``; lines with a ``fault`` are listed as ``line``.

    ``describe`` adds what a file's name tells to a DataFrame with ``path``. Unwanted files are the few, so theirs is
    the list that gets joined: while it is small, the texts themselves are not shuffled. ``large`` are the same files
    as lines, given if there are wanted ones above ``max_bytes``; these are read in splits, with the same result.
    """
    texts = read_texts(found, max_bytes)
    if unwanted is not None:
        texts = texts.join(unwanted.select("path"), "path", "left_anti")
    located = locate_columns(describe(read_header(texts, "text", skip, header_rows, sep, escapes)), mapping, helpers)
    rows = explode_rows(located, sep, keep_lines=True)
    if large is not None:
        lines = split_lines(large, max_bytes)
        if unwanted is not None:
            lines = lines.join(unwanted.select("path"), "path", "left_anti")
        rows = rows.unionByName(large_file_rows(lines, describe, mapping, helpers, skip, header_rows, sep, escapes))
    return rows.drop("path")
