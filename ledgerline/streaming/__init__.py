"""ledgerline.streaming."""
