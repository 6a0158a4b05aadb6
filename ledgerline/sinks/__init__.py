"""ledgerline.sinks."""
