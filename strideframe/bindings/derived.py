"""Files that tasks write from driver tables, as input of the file-source queries."""

from __future__ import annotations

import io
import os
import tarfile
import zipfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from strideframe.session import qualified, work_dir
from strideframe.sources.tables import read

STAGE = "stageii-smplh-v1"
NATIVE = "amass-smplh-g-v1"


def _put(folder: str, name: str, write) -> None:
    """Let `write` fill a stream beside the target, then rename, so that a task that runs twice is harmless."""
    from pyarrow import fs
    system, inner = fs.FileSystem.from_uri(folder)
    system.create_dir(inner, recursive=True)
    part = f"{inner}/.{name}.{os.getpid()}"
    with system.open_output_stream(part) as f:
        write(f)
    system.move(part, f"{inner}/{name}")


def _tar(stream, members, mode="w|gz") -> None:
    """Members go to the stream one by one, so the memory is that of one."""
    with tarfile.open(fileobj=stream, mode=mode) as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


def _zip(stream, members) -> None:
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members:
            z.writestr(name, data)


def _npz(i: int) -> bytes:
    """A motion member; its defects follow the row number."""
    frames = i % 5 + 1
    arrays = {"poses": np.zeros((frames, 155 if i % 11 == 0 else 156)), "trans": np.zeros((frames, 4 if i % 17 == 0 else 3)), "betas": np.zeros(10 if i % 19 == 0 else 16),
              "gender": np.array(b"Male" if i % 2 else "female"), "mocap_framerate": np.array(0.0 if i % 13 == 0 else 60.0)}
    if i % 7:
        arrays["dmpls"] = np.zeros((frames + (i % 23 == 0), 8))
    buf = io.BytesIO()
    np.savez(buf, **arrays)
    return buf.getvalue()


def archives(spark, d, kind: str) -> str:
    """One archive per Arrow batch of documents, so its size is bounded; returns the folder."""
    folder = qualified(spark, work_dir(spark, f"archives-{kind}"))

    def build(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            base = pdf["source"] + "/" + pdf["lang"] + "/doc" + pdf["doc_id"].astype(str)
            if kind.startswith("npz"):
                members = ((f"{b}_poses.npz", _npz(int(i))) for b, i in zip(base, pdf["doc_id"]))
            else:
                members = ((f"{b}.txt" if i % 3 else f"{b}.md", t.encode()) for b, i, t in zip(base, pdf["doc_id"], pdf["text"]))
            end, pack = {"zip": ("zip", _zip), "npz-tar": ("tar", lambda f, m: _tar(f, m, "w|"))}.get(kind, ("tar.gz", _tar))
            _put(folder, f"part-{int(pdf['doc_id'].iloc[0]):09d}.{end}", lambda f: pack(f, members))
            yield pd.DataFrame({"n": [len(pdf)]})

    columns = ["doc_id", "source", "lang"] + ["text"] * (not kind.startswith("npz"))
    read(spark, d, "documents").select(*columns).mapInPandas(build, "n bigint").agg(F.sum("n")).collect()
    return folder


def page_objects(spark, d) -> str:
    """One file per page under objects/, with the extension by page number; returns the folder."""
    folder = qualified(spark, work_dir(spark, "objects"))

    def build(batches):
        for pdf in batches:
            for i, html in zip(pdf["page_id"], pdf["html"]):
                ext = ("html", "json", "bin", "xyz")[int(i) % 4]
                _put(folder, f"page{int(i)}.{ext}", lambda f: f.write(html.encode()))
            yield pd.DataFrame({"n": [len(pdf)]})

    read(spark, d, "pages").select("page_id", "html").mapInPandas(build, "n bigint").agg(F.sum("n")).collect()
    return folder
