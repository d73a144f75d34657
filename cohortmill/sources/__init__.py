"""Where tables come from and where they go: trees, listings, packs, ledgers, documents."""
