"""ledgerline.operators."""
