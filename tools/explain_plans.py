"""Print the physical plans of the headline queries as markdown.

    python tools/explain_plans.py [sf_dir] > PLANS.md.new
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = ["scd2_merge_batch", "latest_per_key", "key_audit", "orders_with_items_flat", "orders_no_items",
         "multi_item_orders", "snapshot_diff",
         "event_history_sound", "event_versions_sound", "snapshot_after_merge",
         "orders_as_of_customer", "events_as_of_hot", "items_size_filter", "yearly_customers", "csv_types",
         "data_files", "sql_bound_orders"]


def main(argv):
    from tidemark.plans.queries import QUERIES
    from tidemark.session import get_session
    sf = argv[0] if argv else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 8)
    for name in NAMES:
        buf = io.StringIO()
        with redirect_stdout(buf):
            QUERIES[name](spark, sf).explain()
        text = re.sub(r"#\d+L?", "", buf.getvalue())
        text = re.sub(r", \[plan_id=\d+\]", "", text)
        text = re.sub(r"Location: InMemoryFileIndex\(\d+ paths\)\[file:[^\]]*\], ", "", text)
        print(f"### {name}\n\n```\n{text.strip()}\n```\n")


if __name__ == "__main__":
    main(sys.argv[1:])
