"""What a user asks for: marts, monthly tables, the ledger and the nightly run."""
