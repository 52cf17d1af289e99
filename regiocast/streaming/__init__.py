from regiocast.streaming.landing import land_available, land_stream

__all__ = ["land_available", "land_stream"]
