from tidemart.streaming.loaders import landing_stream, stream_upsert

__all__ = ["landing_stream", "stream_upsert"]
