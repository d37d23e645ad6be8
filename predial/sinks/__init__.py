"""Writers, guards before and checks after them, staging and catalog entries."""
