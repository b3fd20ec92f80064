"""File sinks. ``mode`` follows DataFrameWriter: ``errorifexists`` fails on
an existing path (K11), ``overwrite`` replaces it (K10). Every writer goes
through Spark's output committer, so a lost executor leaves no partial
result in the destination."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_key_value_text(df: DataFrame, path: str, key: str, value: str,
                         mode: str = "errorifexists", sort: bool = True, route: str | None = None) -> None:
    """K1 (+O6): ``key<TAB>value`` lines, key-ordered inside each part file;
    with ``route`` in a folder for each value of that column (O3)."""
    by = [route] if route else []
    out = df.hint("rebalance", route) if route else df
    out = out.sortWithinPartitions(*by, key) if sort else out
    lines = F.concat_ws("\t", F.col(key).cast("string"), F.col(value).cast("string")).alias("value")
    out.select(*by, lines).write.mode(mode).partitionBy(*by).text(path)


def write_routed(df: DataFrame, path: str, route: str, order: list[str], mode: str = "errorifexists") -> None:
    """O3/O4 + O6: Parquet files in one folder for each value of ``route``,
    rows sorted by ``order`` in each file. The rows are dealt by ``rebalance``,
    so Spark splits a hot route over several tasks and files instead of giving
    it to one."""
    (df.hint("rebalance", route).sortWithinPartitions(route, *order)
     .write.mode(mode).partitionBy(route).parquet(path))


#: More rows than this are no tiny result.
SINGLE_ROWS = 100_000


def write_single_row(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K2 (+O7): a tiny result as one tab-separated part file; NULL -> empty.
    A result of more than ``SINGLE_ROWS`` rows is an error before any is
    written: one task would have to write it."""
    if df.limit(SINGLE_ROWS + 1).count() > SINGLE_ROWS:
        raise ValueError(f"more than {SINGLE_ROWS} rows are too many for one file")
    df.coalesce(1).write.mode(mode).option("sep", "\t").option("header", "false").csv(path)


def write_lines(df: DataFrame, path: str, column: str = "line", line_sep: str = "\r\n",
                mode: str = "overwrite") -> None:
    """K3/K4/K5: one text line per row with the given terminator, into an
    output directory (e.g. ``.../average_delay``) of committed part files."""
    df.select(F.col(column).alias("value")).write.mode(mode).option("lineSep", line_sep).text(path)


def dump(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K6: the whole relation, one parenthesised line a row, NULL empty."""
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    line = F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")"))
    write_lines(df.select(line.alias("line")), path, line_sep="\n", mode=mode)


def write_average_delay(text: DataFrame, out_dir: str, mode: str = "overwrite") -> str:
    """K3 + K4: the monthly text lines, CRLF-terminated, as committed part
    files in ``<out_dir>/average_delay``; returns that directory."""
    target = out_dir.rstrip("/") + "/average_delay"
    write_lines(text, target, column="line", line_sep="\r\n", mode=mode)
    return target


def write_named_parts(df: DataFrame, out_dir: str, prefix: str, column: str = "line",
                      line_sep: str = "\r\n", overwrite: bool = False) -> list[str]:
    """K4: text parts named ``<prefix>NNNNN`` directly in ``out_dir``.

    Spark names its own part files, so the lines are first committed to a
    staging directory inside ``out_dir`` and then renamed (metadata-only on
    HDFS and local disks; one rename per part file, done by the driver)."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(out_dir)
    fs = root.getFileSystem(conf)
    if fs.exists(root):
        clash = [st for st in fs.listStatus(root) if st.getPath().getName().startswith(prefix)]
        if clash and not overwrite:
            raise FileExistsError(f"{out_dir} already holds {prefix}* files")
    else:
        clash = []
    staging = f"{out_dir.rstrip('/')}/_staging_{prefix.rstrip('_')}_{uuid.uuid4().hex[:12]}"
    write_lines(df, staging, column=column, line_sep=line_sep, mode="errorifexists")
    for st in clash:  # the new lines are committed; only now the old ones go
        fs.delete(st.getPath(), False)
    parts = sorted(str(st.getPath()) for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(staging))
                   if st.getPath().getName().startswith("part-"))
    names = []
    for i, part in enumerate(parts):
        target = jvm.org.apache.hadoop.fs.Path(root, f"{prefix}{i:05d}")
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(part), target):
            raise OSError(f"could not rename {part} to {target}")
        names.append(str(target))
    fs.delete(jvm.org.apache.hadoop.fs.Path(staging), True)
    return names
