"""The model seam: recognition engines, mediation and correction as injected functions, loaded once in each task."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions import distance as D
from folioforge.functions import patterns as P

#: name -> function without arguments that loads the engine and gives a function from crop bytes to text
ENGINES: dict[str, Callable[[], Callable[[bytes], str]]] = {}


def register(name: str):
    def add(load):
        ENGINES[name] = load
        return load

    return add


def command_engine(command: list[str], timeout: float = 600.0) -> Callable[[], Callable[[bytes], str]]:
    """An engine that is a program: it gets the crop on its input and prints the text; it may take ``timeout`` seconds."""

    def load():
        import subprocess

        return lambda crop: subprocess.run(command, input=crop, capture_output=True, timeout=timeout, check=True).stdout.decode("utf-8", "replace")

    return load


def run_engines(crops: DataFrame, engines: list[str], registry: dict | None = None) -> DataFrame:
    """(page, region, content) by engine: page, region, engine, status, text, error. Unknown engines are skipped; an
    error is the value of its cell."""
    known = {n: (registry or ENGINES)[n] for n in engines if n in (registry or ENGINES)}

    def run(batches):
        ready: dict = {}
        for pdf in batches:
            rows = []
            for page, region, content in zip(pdf["page"], pdf["region"], pdf["content"], strict=True):
                for name, load in known.items():
                    try:
                        if name not in ready:
                            ready[name] = load()
                        rows.append((page, region, name, "OK", ready[name](bytes(content)), None))
                    except Exception as e:
                        rows.append((page, region, name, "ERROR", None, f"{type(e).__name__}: {e}"[:500]))
            yield pd.DataFrame(rows, columns=["page", "region", "engine", "status", "text", "error"])

    return crops.select("page", "region", "content").mapInPandas(run, "page string, region string, engine string, status string, text string, error string")


def serving_models(models: DataFrame) -> DataFrame:
    return models.where("status = 'ok'")


def mediate(candidates: DataFrame, ask: Callable[[], Callable[[str, bytes | None], str]], prompt: str, keys: list[str] | None = None, minimum: int = 2) -> DataFrame:
    """One text from several reads of a column (keys, engine, text, image): the model sees the prompt, the reads and the image.

    Columns with fewer than ``minimum`` reads are left out. ``ask`` is loaded once in each task.
    """
    keys = keys or ["page_id"]
    reads = F.array_sort(F.collect_list(F.struct("engine", "text")))
    grouped = candidates.where(F.regexp_like("text", F.lit(r"\S"))).groupBy(*keys).agg(reads.alias("_r"), F.first("image", ignorenulls=True).alias("_i")).where(F.size("_r") >= minimum)
    shown = F.array_join(F.transform("_r", lambda x: F.concat(F.lit("["), x["engine"], F.lit("]\n"), x["text"])), "\n\n")
    asked = grouped.select(*keys, F.concat(F.lit(prompt + "\n\n"), shown).alias("prompt"), F.col("_i").alias("image"))
    schema = ", ".join([*(f"{k} {asked.schema[k].dataType.simpleString()}" for k in keys), "text string", "error string"])

    def run(batches):
        model = None
        for pdf in batches:
            texts, errors = [], []
            for q, image in zip(pdf["prompt"], pdf["image"], strict=True):
                try:
                    model = model or ask()
                    texts.append(model(q, image)), errors.append(None)
                except Exception as e:
                    texts.append(None), errors.append(f"{type(e).__name__}: {e}"[:500])
            yield pdf[keys].assign(text=texts, error=errors)

    return asked.mapInPandas(run, schema)


# correction with protected data


def _protected(token: str) -> bool:
    import re

    core = token.strip(",.;:()[]\"'«»")
    initial = r"[A-ZÅÄÖ][.:][A-Za-zÅÄÖåäö]?|[A-ZÅÄÖ][.:]?"
    return bool(core) and bool(re.search(r"\d", core) or re.fullmatch(initial, token) or re.fullmatch(initial, core))


def restore_protected(source: str, corrected: str) -> str:
    """``corrected`` with the source's numbers and initials as they were.

    In each stretch that changed, a protected token takes the place of the output token most like it (the first on
    ties), or is put back where it was deleted.
    """
    from difflib import SequenceMatcher

    old, new = source.split(), corrected.split()
    if old == new:
        return " ".join(new)
    swap: dict[int, str] = {}
    back: list[tuple[int, str]] = []
    for kind, i1, i2, j1, j2 in SequenceMatcher(a=old, b=new, autojunk=False).get_opcodes():
        if kind == "equal":
            continue
        for token in filter(_protected, old[i1:i2]):
            if j1 == j2:
                back.append((j1, token))
            else:
                swap[min(range(j1, j2), key=lambda j: D.ned(token, new[j]))] = token
    out = []
    for j in range(len(new) + 1):
        out += [t for at, t in back if at == j]
        if j < len(new):
            out.append(swap.get(j, new[j]))
    return " ".join(out)


def correct_line(line: str, generate: Callable[[str], str], max_bytes: int = P.CHUNK_BYTES, min_letters: int = P.MIN_LETTERS) -> str:
    """A line through the model in chunks of whole words, each accepted or kept, protected data restored."""
    if not line.strip():
        return line

    def chunk(text: str) -> str:
        if sum(map(str.isalpha, text)) < min_letters:
            return text
        try:
            got = generate(text) or text
        except Exception:
            return text
        odd = len(got) > len(text) * P.ACCEPT_GROWTH + P.ACCEPT_EXTRA or len(text.strip()) < P.ACCEPT_SHORT
        drifted = odd and D.ned(text.strip(), got.strip()) > P.ACCEPT_NED  # few are odd, so few are measured
        return text if drifted else got

    chunks, size = [[]], 0
    for w in line.strip().split(" "):
        n = len(w.encode()) + 1
        if chunks[-1] and size + n > max_bytes:
            chunks.append([])
            size = 0
        chunks[-1].append(w)
        size += n
    whole = len(line.strip().encode()) <= max_bytes
    corrected = chunk(line.strip()) if whole else " ".join(chunk(" ".join(c)) for c in chunks)
    return restore_protected(line, corrected) if any(map(_protected, line.split())) else " ".join(corrected.split())


def correct_texts(df: DataFrame, load: Callable[[], Callable[[str], str]], text: str = "text", out: str = "corrected") -> DataFrame:
    """``df`` with the text corrected line by line; the model is loaded once in each task."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, {out} string"

    def run(batches):
        generate = None
        for pdf in batches:
            generate = generate or load()
            fix = lambda t: None if t is None else "\n".join(correct_line(x, generate) for x in t.replace("\r\n", "\n").replace("\r", "\n").split("\n"))  # noqa: B023, E731
            yield pdf.assign(**{out: pdf[text].map(fix)})

    return df.mapInPandas(run, schema)
