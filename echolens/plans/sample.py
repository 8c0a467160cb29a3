"""Order mirror -> tier-quota sample with its manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolens import constants as C
from echolens.operators import mirror as M
from echolens.operators import sampling
from echolens.session import durable


def sample_mirror(
    mirror: DataFrame, size: int, seed: int, quota: Sequence[int] = C.DEFAULT_QUOTA,
    collected: DataFrame | None = None, source: str = "mirror",
    exclude_sources: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """Sample, allocation, manifest and the lines left out."""
    firsts = M.first_rows_per_video(M.keyed_rows(mirror))
    videos = firsts if collected is None else sampling.without_collected(firsts, collected)
    videos = durable(videos)
    sample, allocation = sampling.quota_sample(videos.drop("lines"), size, quota, seed)
    rejects = M.reject_counts(mirror)
    dropped = rejects.agg(F.coalesce(F.sum("lines"), F.lit(0))).scalar()
    if collected is None:
        excluded = F.lit(0)
    else:
        excluded = collected.select("video_id").distinct().agg(F.count(F.lit(1))).scalar()
    record = sampling.manifest(
        allocation, seed, dropped, excluded, source, exclude_sources
    )
    return {
        "sample": sample, "allocation": allocation, "manifest": record,
        "rejected": M.rejected_rows(mirror),
    }
