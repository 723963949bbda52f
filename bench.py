"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local
cores.  Every query runs in full into the no-op sink; the first one also warms up
the session, so a small untimed query goes before it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gavel.queries.registry import registered  # noqa: E402
from gavel.session import local_session  # noqa: E402

HEADLINE = (
    "gap_detection part_timeline asof_video speaker_turns anchored_offset_clusters keep_fullest match_transcripts "
    "listing nested_documents summary_entries consolidated_amounts meeting_finance folded_paragraphs "
    "content_word_counts acronyms merged_speakers ranked_entities caption_matches aligned_offsets truecased_turns "
    "directive_counts meeting_coverage document_volume document_manifest snapshot_changes video_candidates page_lines "
    "agenda_table_rows incremental_pickup"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    every = registered()
    every["year_filter"][0](spark, folder).count()
    times: dict[str, float] = {}
    for name in os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split():
        start = time.perf_counter()
        every[name][0](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
