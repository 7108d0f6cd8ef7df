"""Feeds: change extracts, file feeds, transaction text, and the driver-table fixtures."""
