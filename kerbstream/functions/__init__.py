"""Column expressions."""

from kerbstream.functions.exact import exact_mean, exact_state, merged_state, state_mean
from kerbstream.functions.metrics import congestion_index, traffic_factor, z_score
from kerbstream.functions.payload import alert_payload, event_time, reading_payload
from kerbstream.functions.quality import reject_reason

__all__ = ["alert_payload", "congestion_index", "event_time", "exact_mean", "exact_state",
           "merged_state", "reading_payload", "reject_reason", "state_mean", "traffic_factor",
           "z_score"]
