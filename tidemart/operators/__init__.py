from tidemart.operators.asof import asof_join
from tidemart.operators.dedupe import latest_per_key
from tidemart.operators.merge import upsert

__all__ = ["asof_join", "latest_per_key", "upsert"]
