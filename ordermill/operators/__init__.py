"""DataFrame-to-DataFrame operators of the silver, gold and forecast layers."""
