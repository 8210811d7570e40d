"""The named queries of the library and their independent SQL counterparts."""
