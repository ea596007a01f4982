"""Steps of the flow: chunk, embed, store, search, account, profile."""
