"""Table profiles on the test tables."""

from __future__ import annotations

from larder.operators import profile
from larder.plans import sales
from larder.registered.binding import Query, bind
from larder.registered.quality import typed_stores


def profiles() -> dict[str, Query]:
    plans = {
        "p01_value_shares": lambda t: profile.value_shares(t.orders, "payment_method"),
        "p01_distributions": lambda t: profile.distributions(t.orders, ["payment_method", "order_status", "store_id"]),
        "p02_means": lambda t: profile.means(t.order_details, ["quantity", "final_item_price"], ["line_number"]),
        "p02_line_summary": lambda t: profile.line_summary(t.order_details),
        "p03_gaps_and_repeats": lambda t: profile.gaps_and_repeats(
            t.returns.select("return_id", "order_id", "product_id"), {"return_id": ["return_id"]}
        ),
        "p04_top_values": lambda t: profile.top_values(t.products, "product_name", 5),
        "p05_counts_by_attribute": lambda t: profile.counts_by_attribute(
            t.inventory.select("store_id"), "store_id", typed_stores(t), "store_type"
        ),
        "a17_active_riders_by_store": sales.active_riders_by_store,
        "p06_return_summary": lambda t: profile.return_summary(t.returns, t.order_details),
    }
    return {name: bind(plan) for name, plan in plans.items()}
