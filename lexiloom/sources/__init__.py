"""Readers and writers of pages, lists, labels, answers, models and sheets."""
