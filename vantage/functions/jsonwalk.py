"""Pure-Python helper run inside Spark tasks: the widget walk of one report document.

This module imports nothing from the package, and it is registered for pickling by value (see
``vantage.operators.reports``). Python workers therefore need no copy of the package on their
path.
"""

from __future__ import annotations


def widget_ids(doc) -> set:
    """Non-empty insight ids of objects with ``type == "widget"`` and a ``widgetData`` key, at any
    depth inside objects and arrays. Iterative, so depth is not limited by the Python stack."""
    found = set()
    stack = [doc]
    while stack:
        node = stack.pop()
        if isinstance(node, dict):
            if node.get("type") == "widget" and "widgetData" in node:
                data = node["widgetData"]
                iid = data.get("insightId") if isinstance(data, dict) else None
                if iid:
                    found.add(str(iid))
            stack.extend(v for v in node.values() if isinstance(v, (dict, list)))
        elif isinstance(node, list):
            stack.extend(v for v in node if isinstance(v, (dict, list)))
    return found


def widget_batches(batches):
    """``mapInPandas`` body: (report_id, structure) batches → (report_id, insight_id) rows.
    Documents that are not valid JSON contribute nothing."""
    import json

    import pandas as pd

    for pdf in batches:
        ids, insights = [], []
        for rid, text in zip(pdf["report_id"], pdf["structure"]):
            if text is None:
                continue
            try:
                doc = json.loads(text)
            except ValueError:
                continue
            for iid in widget_ids(doc):
                ids.append(rid)
                insights.append(iid)
        yield pd.DataFrame({"report_id": ids, "insight_id": insights}, dtype=object)
