"""Reading landed data and writing reports and snapshot packs."""
