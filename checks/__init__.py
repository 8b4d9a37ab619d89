"""Registered queries, their SQL counterparts, and the frames both are built on."""
