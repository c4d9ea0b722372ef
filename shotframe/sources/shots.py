"""Shot tables from files: column lookup with fallbacks, and adapters of other layouts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shotframe.sources.stacks import HDF5, read_stack, read_stacked_image

DETECTORS = ("epix10k2M", "Rayonix", "Jungfrau4M")


def read_shots(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet shot table, or array files (HDF5 or .npy, alone or in a folder named .stack) read by ranges of shots."""
    return read_stack(spark, path) if path.rstrip("/").endswith((*HDF5, ".npy", ".stack")) else spark.read.parquet(path)


def first_column(df: DataFrame, names: Iterable[str]) -> str | None:
    return next((n for n in names if n in df.columns), None)


def detector(df: DataFrame, preferred: Iterable[str] = DETECTORS) -> str | None:
    """The first preferred detector that some column is of."""
    return next((d for d in preferred if any(c.split("/")[0] == d for c in df.columns)), None)


def azimuthal_column(df: DataFrame, det: str) -> str:
    """Patterns by either integrator."""
    found = first_column(df, (f"{det}/azav_azav", f"{det}/pyfai_azav"))
    if not found:
        raise KeyError(f"no azimuthal patterns of {det}")
    return found


def scan_variable(df: DataFrame, wanted: str | list[str] | None, total: int | None = None, shot: str = "shot") -> tuple[Column, str | None]:
    """The scan column and its name: that wanted, the first present of several, else the laser delay readback, else
    the shot number spread evenly over 0 to total, without a name."""
    names = [wanted] if isinstance(wanted, str) else list(wanted or [])
    found = first_column(df, [f"scan/{n}" for n in names] + names)
    if found:
        return F.col(f"`{found}`"), found.removeprefix("scan/")
    if "enc/lasDelay" in df.columns:
        return F.col("`enc/lasDelay`"), "lxt_fast"
    n = total if total is not None else df.count()
    return F.col(shot).cast("double") * (n / max(1, n - 1)), None


#: Names of columns in shot files and what the analyses call them: fixed values.
STANDARD = {"lightStatus/xray": "xray", "lightStatus/laser": "laser", "epics/ccm_E": "ccm", "epicsUser/ccm_E_setpoint": "ccm_set"}


def standard_columns(df: DataFrame, det: str | None = None, absorption: str | None = None, emission: str | None = None) -> DataFrame:
    """df with the analyses' names beside the files': xray, laser, ccm, ccm_set; azav, the patterns of a detector (the first
    preferred one by default) by either integrator; xas_raw and roi_area, the sum and the image of a region of the detectors
    named, or of the only one that has such a column. Names that are there already stay."""
    more = {short: long for long, short in STANDARD.items() if long in df.columns}
    found = det or detector(df)
    if found and first_column(df, (f"{found}/azav_azav", f"{found}/pyfai_azav")):
        more["azav"] = azimuthal_column(df, found)
    for short, end, wanted in (("xas_raw", "/ROI_0_sum", absorption), ("roi_area", "/ROI_0_area", emission)):
        own = [c for c in df.columns if c.endswith(end) and (wanted is None or c == wanted + end)]
        if len(own) == 1:
            more[short] = own[0]
    return df.withColumns({short: F.col(f"`{long}`") for short, long in more.items() if short not in df.columns})


def numbers(line: Column, separator: str = ",") -> Column:
    """The numbers of a delimited line; null where a part is none."""
    return F.transform(F.split(line, separator), lambda x: F.trim(x).try_cast("double"))


def read_numbers(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """Delimited numbers as (line_text, values)."""
    return spark.read.text(path).select(F.col("value").alias("line_text"), numbers(F.col("value"), separator).alias("values"))


def sniff(path: str) -> str:
    """'hdf5', 'numpy', 'parquet' or 'text' by the first bytes of a local file."""
    with open(path, "rb") as f:
        head = f.read(8)
    return {b"\x89HDF\r\n\x1a\n": "hdf5"}.get(head) or ("numpy" if head[:6] == b"\x93NUMPY" else "parquet" if head[:4] == b"PAR1" else "text")


def read_mask(spark: SparkSession, path: str | None) -> DataFrame | None:
    """(row, col, value) of a mask file, Parquet or .npy; None without one."""
    if not path:
        return None
    return read_stacked_image(spark, path) if path.endswith(".npy") else spark.read.parquet(path).select("row", "col", "value")


def write_hits(hits: DataFrame, folder: str, peaks_col: str = "peaks") -> None:
    """Hits as Parquet: files of tasks together are the whole table, so there is no master to build."""
    hits.write.mode("overwrite").parquet(f"{folder}/hits")


def write_tiffs(images: DataFrame, folder: str, shot: str = "shot", image: str = "image") -> DataFrame:
    """An uncompressed 32-bit TIFF file per image, masked (null) pixels as 0; returns the file names."""
    import struct

    from pyarrow import fs

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        for p in parts:
            names = []
            for s, m in zip(p[shot], p[image], strict=True):
                a = np.nan_to_num(np.array([[0.0 if v is None else v for v in r] for r in m], "<f4"))
                fields = [(256, a.shape[1]), (257, a.shape[0]), (258, 32), (259, 1), (262, 1), (273, 8), (277, 1), (278, a.shape[0]), (279, a.nbytes), (339, 3)]
                tail = struct.pack("<H", len(fields)) + b"".join(struct.pack("<HHII", t, 4, 1, v) for t, v in fields) + struct.pack("<I", 0)
                with store.open_output_stream(f"{top}/{s}.tif") as f:
                    f.write(struct.pack("<2sHI", b"II", 42, 8 + a.nbytes) + a.tobytes() + tail)
                names.append(f"{s}.tif")
            yield pd.DataFrame({"file": names})

    return images.select(shot, image).mapInPandas(write, "file string")
