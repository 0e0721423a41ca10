"""DataFrame → DataFrame operators; defaults are the contract's constants."""
