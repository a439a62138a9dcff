"""Sales message stream (W4) on Structured Streaming."""

from sluice.streaming.sales import (MESSAGE_SCHEMA, SALES_SCHEMA, choose_partition,
                                    decode_sales, period_bounds, publish_messages,
                                    read_rejects, read_sink, run_sales_sink, sales_messages,
                                    sales_source)

__all__ = ["MESSAGE_SCHEMA", "SALES_SCHEMA", "choose_partition", "decode_sales",
           "period_bounds", "publish_messages", "read_rejects", "read_sink", "run_sales_sink",
           "sales_messages", "sales_source"]
