"""Notifications, exported files, form rows and mapping definitions."""
