"""harborline.operators"""
