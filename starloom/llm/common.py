"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.storage import materialize
from starloom.session import checkpoint_root

__all__ = ["by_bytes", "carried", "checkpoint_root", "create", "map_arrow", "materialize", "open_shared", "read_table", "shared_folder", "texts", "unpacked"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id long, text string) of any table: a null text is an empty one,
    all other columns are pruned, so their names cannot clash. ``keep`` names
    columns to carry along, in one struct ``_with``."""
    kept = [F.struct(*[F.col(c) for c in keep]).alias("_with")] if keep else []
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *kept)


def carried(df: DataFrame) -> tuple[list[str], str]:
    """The name of ``texts``' struct if ``df`` has it, and its part of a schema."""
    kind = dict(df.dtypes).get("_with")
    return (["_with"], f", _with {kind}") if kind else ([], "")


def unpacked(df: DataFrame) -> DataFrame:
    """``df`` with the struct's columns in its place."""
    return df.select(*[c for c in df.columns if c != "_with"], "_with.*") if "_with" in df.columns else df


_shipped: set[str] = set()


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``df.mapInArrow`` whose workers can import this package: its sources go
    with the application (``addPyFile``), once."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="starloom-src-")) / "starloom_src.zip"  # the driver serves it to executors
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(package.rglob("*.py")):
                z.write(p, p.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)

    def run(batches):
        try:
            yield from function(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks,
    and what one stage needed for a moment would stay in them."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)  # of the GNU library; others need no call


def by_bytes(column: pa.Array, limit: int):
    """Index ranges of a string column that hold about ``limit`` bytes each
    (one longer value makes a range of its own)."""
    sizes = pc.binary_length(column).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's address below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/starloom-files/{uuid.uuid4().hex}/{name}"


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


@contextlib.contextmanager
def create(folder: str, name: str):
    """Yield (address, stream) of a new file in a shared folder. The name gets
    a random part, so attempts of a task never meet; a reader takes only the
    files that committed rows name."""
    uri = f"{folder.rstrip('/')}/{uuid.uuid4().hex[:12]}-{name}"
    system, path = _filesystem(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        yield uri, out


def open_shared(uri: str):
    """Open a file of a shared folder for reading at any place."""
    system, path = _filesystem(uri)
    return system.open_input_file(path)
