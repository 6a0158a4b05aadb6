"""ledgerline.plans."""
