"""Page images: skew, binarisation, quality, header and gutter, crops. numpy kernels inside Arrow stages; scores are SQL.

Images are uint8 arrays, ink 0 on paper 255. Decoding and encoding are injected (``decode``: bytes -> gray array).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import patterns as P


def otsu_threshold(gray: np.ndarray) -> int:
    n = np.bincount(gray.ravel(), minlength=256).astype(float)
    below, mass = np.cumsum(n), np.cumsum(n * np.arange(256))
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (mass[-1] * below - mass * below[-1]) ** 2 / (below * above)
    return int(np.nan_to_num(between).argmax())


def binarize_otsu(gray: np.ndarray) -> np.ndarray:
    return np.where(gray > otsu_threshold(gray), 255, 0).astype(np.uint8)


def box_mean(x: np.ndarray, window: int) -> np.ndarray:
    """Mean of the window around each pixel, edges reflected; by an integral image."""
    r = window // 2
    padded = np.pad(x.astype(np.float64), r, mode="symmetric")
    total = np.pad(padded.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    return (total[window:, window:] - total[:-window, window:] - total[window:, :-window] + total[:-window, :-window]) / window**2


def binarize_sauvola(gray: np.ndarray, window: int = 31, k: float = 0.2, spread: float = 128.0) -> np.ndarray:
    mean = box_mean(gray, window)
    std = np.sqrt(np.clip(box_mean(gray.astype(np.float64) ** 2, window) - mean**2, 0, None))
    return np.where(gray > mean * (1 + k * (std / spread - 1)), 255, 0).astype(np.uint8)


def despeckle(binary: np.ndarray) -> np.ndarray:
    """Ink that no 2 x 2 square of ink covers goes."""
    ink = np.pad(binary == 0, 1)
    square = ink[:-1, :-1] & ink[1:, :-1] & ink[:-1, 1:] & ink[1:, 1:]
    covered = square[:-1, :-1] | square[1:, :-1] | square[:-1, 1:] | square[1:, 1:]
    return np.where(covered, 0, 255).astype(np.uint8)


def rotate(image: np.ndarray, degrees: float, fill: int | None = None) -> np.ndarray:
    """Rotation about the centre, nearest pixel; outside is ``fill`` or the nearest edge."""
    h, w = image.shape
    a = np.radians(degrees)
    dy, dx = np.arange(h, dtype=np.float64)[:, None] - h / 2, np.arange(w, dtype=np.float64) - w / 2
    sx, sy = np.cos(a) * dx - np.sin(a) * dy, np.sin(a) * dx + np.cos(a) * dy
    sx += w / 2
    sy += h / 2
    sx, sy = (np.rint(v, out=v).astype(np.int64) for v in (sx, sy))
    outside = None if fill is None else (sx < 0) | (sx >= w) | (sy < 0) | (sy >= h)
    at = np.clip(sy, 0, h - 1, out=sy)
    at *= w
    at += np.clip(sx, 0, w - 1, out=sx)
    out = image.take(at)
    return out if outside is None else np.where(outside, fill, out)


def skew_by_projection(gray: np.ndarray, reach: float = 4.0, coarse: float = 0.5, fine: float = 0.1) -> float:
    """Angle at which rows of ink vary most; on a copy of at most 1000 pixels a side, first coarse then fine."""
    step = max(1, -(-max(gray.shape) // 1000))
    h, w = (s // step * step for s in gray.shape)
    small = gray[:h, :w].reshape(h // step, step, w // step, step).mean((1, 3)).astype(np.uint8)
    y, x = np.nonzero(small <= otsu_threshold(small))
    rows, beyond = small.shape[0], sum(small.shape)
    dy, dx = np.arange(rows) - rows / 2, np.arange(small.shape[1]) - small.shape[1] / 2

    def sharp(angle: float) -> float:
        """Variance of the ink of rows, each pixel of ink being put into the row that a turn by ``angle`` brings it to."""
        a = np.radians(angle)
        at = (np.cos(a) * dy)[y]
        at -= (np.sin(a) * dx)[x]
        at += rows / 2
        to = np.rint(at, out=at).astype(np.int64)
        to += beyond  # what leaves the page is counted beside its rows
        return float(np.bincount(to, minlength=rows + 2 * beyond)[beyond : beyond + rows].var())

    best = max(np.arange(-reach, reach + 1e-9, coarse), key=sharp)
    return float(max(np.arange(best - coarse, best + coarse + 1e-9, fine), key=sharp))


def skew_by_lines(gray: np.ndarray, votes: int = 300, most: int = 200) -> float | None:
    """Median angle of the strongest near-level lines through edges (Hough votes within ten degrees); None without any."""
    gy = np.abs(np.gradient(gray.astype(np.float32), axis=0))
    y, x = np.nonzero(gy > 50)
    if not len(y):
        return None
    angles = np.arange(-9.5, 10, 0.5)
    found = []
    for a in angles:
        rho = np.rint(y * np.cos(np.radians(a)) - x * np.sin(np.radians(a))).astype(int)
        n = np.bincount(rho - rho.min())
        found += [(int(v), float(a)) for v in n[n >= votes]]
    found.sort(reverse=True)
    return float(np.median([a for _, a in found[:most]])) if found else None


def deskew(gray: np.ndarray, cross_check: bool = True) -> tuple[np.ndarray, float]:
    angle = skew_by_projection(gray)
    other = skew_by_lines(gray) if cross_check else None
    if other is not None and abs(other - angle) < 1.5:
        angle = (angle + other) / 2
    return (gray, 0.0) if abs(angle) < 0.05 else (rotate(gray, angle), angle)


def laplacian_variance(gray: np.ndarray) -> float:
    p = np.pad(gray.astype(np.int16 if gray.dtype == np.uint8 else np.float64), 1, mode="reflect")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).astype(np.float64).var())


def quality_score(lap: Column, std: Column, ink: Column) -> Column:
    """0 to 100, one decimal."""
    part = lambda v, norm: F.least(v / norm, F.lit(1.0))
    return F.round((part(lap, P.LAP_NORM) * 0.45 + part(std, P.STD_NORM) * 0.35 + part(ink, P.INK_NORM) * 0.20) * 100, 1)


def is_faded(lap: Column, std: Column, ink: Column) -> Column:
    return (lap < P.FADED["laplacian_var"]) | (std < P.FADED["contrast_std"]) | (ink < P.FADED["ink_density"])


def gutter_class(ratio: Column) -> Column:
    return F.when(ratio < P.GUTTER_OK, "ok").when(ratio < P.GUTTER_WEAK, "weak").otherwise("poor")


def smooth(x: np.ndarray, window: int) -> np.ndarray:
    """Moving average; beyond the ends there are zeros, and edges are divided by the full window."""
    return x if window <= 1 else np.convolve(x, np.full(window, 1 / window), mode="same")


def text_bands(flags: np.ndarray, gap: int) -> list[tuple[int, int]]:
    """First and last row of each band of text rows, bands no more than ``gap`` rows apart being one."""
    rows = np.flatnonzero(flags)
    if not len(rows):
        return []
    new = np.append(True, np.diff(rows) > gap + 1)
    last = np.append(np.flatnonzero(new)[1:] - 1, len(rows) - 1)
    return list(zip(rows[new].tolist(), rows[last].tolist(), strict=True))


def header_end(binary: np.ndarray, max_frac: float = 0.13, window: int = 5) -> tuple[int, str]:
    """Row where the header ends, and how sure: ok, weak_no_valley, degenerate, no_header_text or page_too_short."""
    h, w = binary.shape
    limit = int(h * max_frac)
    if limit < 20:
        return 0, "page_too_short"
    margin = max(int(0.02 * h), 24)
    ink = smooth((binary == 0).sum(1).astype(float), window)[:limit].copy()
    ink[:margin] = 0
    peak = ink.max(initial=0.0)
    text = ink > max(0.012 * w, 0.10 * peak)
    strong = np.flatnonzero(ink >= max(0.04 * w, 0.30 * peak))
    strong = strong[strong >= margin]
    if not len(strong):
        strong = np.flatnonzero(text)
        if not len(strong):
            return 0, "no_header_text"
    top = int(strong[0])
    reach = min(limit - 1, top + int(0.035 * h))
    bands = text_bands(text[top : reach + 1], max(int(0.0035 * h), 4) - 1)
    end = top + (bands[0][1] if bands and bands[0][0] == 0 else 0)
    low, high = end + 1, min(end + int(0.035 * h), limit)
    if high <= low + 1:
        return min(end + max(int(0.005 * h), 8), limit), "weak_no_valley"
    cut = min(max(low + int(ink[low:high].argmin()), top + 2), limit)
    return (0, "degenerate") if cut <= top + 2 else (cut, "ok")


def gutter(binary: np.ndarray, top: int = 0, middle: float = 0.34, window: int = 21) -> tuple[int, dict]:
    """Column of least ink in the middle of the body, and the figures behind it."""
    _, w = binary.shape
    ink = smooth((binary[top:] == 0).sum(0).astype(float), window)
    lo, hi = int(w * (0.5 - middle / 2)), int(w * (0.5 + middle / 2))
    if hi <= lo:
        return w // 2, {"search_lo": lo, "search_hi": hi, "gutter_ratio": None}
    at = lo + int(ink[lo:hi].argmin())
    mean = lambda a, b: float(ink[int(w * a) : int(w * b)].mean())
    left, right = mean(0.10, 0.40), mean(0.60, 0.90)
    some = ink[ink > 0]
    return at, {
        "search_lo": lo, "search_hi": hi, "gutter_ink": float(ink[at]), "left_mass": left, "right_mass": right,
        "gutter_ratio": float(ink[at] / max((left + right) / 2, 1.0)), "body_median": float(np.median(some)) if len(some) else 1.0,
    }


#: bytes of crops that a batch of results holds, about
CROP_BYTES = 16 << 20
PAGE_SPLIT = (
    "page string, height int, width int, skew_angle_deg double, laplacian_var double, ink_density double, contrast_std double, mean_luminance double, "
    "header_end int, header_status string, split_x int, search_lo int, search_hi int, gutter_ink double, left_mass double, right_mass double, "
    "gutter_ratio double, body_median double, header binary, colL binary, colR binary, error string"
)


def split_pages(images: DataFrame, decode, encode=None, method: str = "sauvola", cross_check: bool = False) -> DataFrame:
    """(page, content) -> geometry, quality figures and crops of each page. An error is a value of its row, never of the job."""
    names = [c.split()[0] for c in PAGE_SPLIT.split(", ")]
    save = encode or (lambda a: a.tobytes())

    def one(page, content):
        row = dict.fromkeys(names) | {"page": page}
        try:
            gray, angle = deskew(decode(bytes(content)), cross_check)
            binary = despeckle(binarize_sauvola(gray) if method == "sauvola" else binarize_otsu(gray))
            end, status = header_end(binary)
            at, diag = gutter(binary, end)
            row |= {
                "height": gray.shape[0], "width": gray.shape[1], "skew_angle_deg": round(angle, 3), "laplacian_var": laplacian_variance(gray),
                "ink_density": float((binary == 0).mean()), "contrast_std": float(gray.std()), "mean_luminance": float(gray.mean()),
                "header_end": end, "header_status": status, "split_x": at, **diag,
                "header": save(gray[:end]) if end else None, "colL": save(gray[end:, :at]), "colR": save(gray[end:, at:]),
            }
        except Exception as e:
            row["error"] = f"{type(e).__name__}: {e}"[:500]
        return row

    def frame(rows):
        return pd.DataFrame(rows, columns=names).astype({c: "Int32" for c in ("height", "width", "header_end", "split_x", "search_lo", "search_hi")})

    def run(batches):
        for pdf in batches:
            rows, size = [], 0
            for p, c in zip(pdf["page"], pdf["content"], strict=True):
                rows.append(one(p, c))
                size += sum(len(rows[-1][k] or b"") for k in ("header", "colL", "colR"))
                if size >= CROP_BYTES:  # the crops are larger than the files that come in
                    yield frame(rows)
                    rows, size = [], 0
            if rows:
                yield frame(rows)

    got = images.select("page", "content").mapInPandas(run, PAGE_SPLIT)
    lap, std, ink = F.col("laplacian_var"), F.col("contrast_std"), F.col("ink_density")
    return got.withColumns(
        {"quality_score": quality_score(lap, std, ink), "faded_flag": is_faded(lap, std, ink), "gutter_conf": gutter_class(F.col("gutter_ratio")), "has_header": F.col("header").isNotNull()}
    )


def fit_side(height: Column, width: Column, most: int = 1600) -> Column:
    """Size of an image whose longer side is at most ``most``."""
    scale = F.least(F.lit(1.0), F.lit(float(most)) / F.greatest(height, width))
    return F.struct(F.floor(height * scale).cast("int").alias("height"), F.floor(width * scale).cast("int").alias("width"))
