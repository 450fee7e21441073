"""Writers: table appends and refreshes, message topics, the done-file manifest."""
