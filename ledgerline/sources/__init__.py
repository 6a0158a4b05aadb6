"""ledgerline.sources."""
