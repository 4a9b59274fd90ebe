"""Tab-separated input and output."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrail.columns import EVENT_SCHEMA, TIMESTAMP


# How ``write_tsv`` writes, for reading its files back: quotes are doubled, a quoted field may
# hold line breaks, and blanks belong to the field. Spark cannot split such a file by lines.
WRITTEN = {
    "escape": '"',
    "multiLine": True,
    "lineSep": "\n",  # or the first line break of a quoted field may be taken for it
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_events(
    spark: SparkSession, path: str, quote: str = '"', written: bool = False
) -> DataFrame:
    """Headerless event files in the order of ``EVENT_SCHEMA``.

    Empty fields and unreadable timestamps become null, short lines are filled
    up with nulls and extra fields dropped. ``quote=""`` takes quotation marks
    as ordinary characters; ``written`` reads the files of ``write_tsv``, which
    have every character of the fields but for empty texts, which become null.
    """
    return (
        spark.read.schema(EVENT_SCHEMA)
        .options(sep="\t", header=False, quote=quote, **(WRITTEN if written else {}))
        .csv(path)
    )


# The column that holds a line which did not parse, and the file a line is from.
REJECTED = "rejected_line"
FILE = "file"


def scan_events(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """Event files line by line: the columns of ``read_events``, its rejected text and its file.

    A line is rejected if it has too few or too many fields or a timestamp that cannot be
    read; ``rejected_line`` is then the line as it is, and its fields are what could be read.
    All columns of a line are parsed whatever a query asks for, so that what is rejected does
    not depend on the query.
    """
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField(REJECTED, T.StringType())])
    options = {"sep": "\t", "header": False, "quote": quote, "mode": "PERMISSIVE"}
    read = spark.read.schema(schema).options(
        **options, columnNameOfCorruptRecord=REJECTED, columnPruning=False
    )
    # Spark converts the fields that a query asks for and no others. Whether a line is rejected
    # hangs on its timestamp, so the rejected text asks for it; any year will do.
    converted = F.coalesce(F.year(TIMESTAMP) > -(10**6), F.lit(True))
    return read.csv(path).withColumns(
        {REJECTED: F.when(converted, F.col(REJECTED)), FILE: F.col("_metadata.file_path")}
    )


def accepted(scanned: DataFrame) -> DataFrame:
    """The events of the lines that parsed, as ``read_events`` gives them."""
    return scanned.filter(F.col(REJECTED).isNull()).select(*EVENT_SCHEMA.fieldNames())


def rejected(scanned: DataFrame) -> DataFrame:
    """The lines that did not parse, with their file and what is wrong with them."""
    fields = F.size(F.split(F.col(REJECTED), "\t", -1))
    wanted = len(EVENT_SCHEMA)
    reason = (
        F.when(fields < wanted, "too few fields")
        .when(fields > wanted, "too many fields")
        .otherwise("unreadable timestamp")
    )
    return scanned.filter(F.col(REJECTED).isNotNull()).select(
        FILE, REJECTED, reason.alias("reason")
    )


def lines_per_file(scanned: DataFrame) -> DataFrame:
    """How many lines of each file were accepted and rejected, from one pass."""
    return scanned.groupBy(FILE).agg(
        F.count_if(F.col(REJECTED).isNull()).alias("accepted"),
        F.count(REJECTED).alias("rejected"),
    )


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """User profiles with a header line; every column is text."""
    return spark.read.options(sep="\t", header=True).csv(path)


def typed_users(users: DataFrame, date_format: str = "MMM d, yyyy") -> DataFrame:
    """User profiles with ``age`` as int and ``registered`` as date; null where unreadable."""
    return users.withColumns(
        {
            "age": F.col("age").try_cast("int"),
            "registered": F.try_to_timestamp("registered", F.lit(date_format)).cast("date"),
        }
    )


def result_name(song_number: int, session_number: int) -> str:
    # Fixed value: the name pattern of the result.
    return f"top_{song_number}_songs_in_{session_number}_longest_session.tsv"


# How ``write_lines`` writes what a line cannot hold.
_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ('"', "\\q"))
_EMPTY, _NULL = "\\e", "\\0"


def write_lines(df: DataFrame, path: str) -> None:
    """Write a line per row below ``path``, which ``read_lines`` reads back whole.

    Line breaks, tabs, quotes and backslashes of texts are escaped, so that a file can be
    split at any line break; empty texts and nulls have signs of their own, so that no line
    of a table with a text column is blank, which readers would skip.
    """
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]

    def escaped(column: Column) -> Column:
        for plain, sign in _ESCAPES:
            column = F.replace(column, F.lit(plain), F.lit(sign))
        return F.when(column == "", _EMPTY).otherwise(F.coalesce(column, F.lit(_NULL)))

    df.withColumns({name: escaped(F.col(name)) for name in text}).write.mode("overwrite").options(
        sep="\t", header=False, quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def read_lines(
    spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA
) -> DataFrame:
    """Files of ``write_lines``; large ones are read by several tasks."""
    text = [f.name for f in schema if isinstance(f.dataType, T.StringType)]
    marks = F.create_map(*[F.lit(x) for plain, sign in _ESCAPES for x in (sign, plain)], F.lit(_EMPTY), F.lit(""))

    def plain(column: Column) -> Column:
        # marks and what lies between them, in order; a text without a mark is left as it is
        parts = F.regexp_extract_all(column, F.lit(r"(\\.|[^\\]+)"), 1)
        whole = F.array_join(
            F.transform(parts, lambda p: F.coalesce(F.try_element_at(marks, p), p)), ""
        )
        return F.when(F.contains(column, F.lit("\\")), F.when(column != _NULL, whole)).otherwise(column)

    read = spark.read.schema(schema).options(
        sep="\t", header=False, quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return read.csv(path).withColumns({name: plain(F.col(name)) for name in text})


def write_tsv(
    df: DataFrame, path: str, single_file: bool = False, header: bool = True
) -> None:
    """Write ``df`` below ``path``.

    Quotes are doubled, nulls and empty strings are empty fields and blanks are
    kept. ``single_file`` is for results of a known small number of rows.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(
        sep="\t",
        header=header,
        escape='"',
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
