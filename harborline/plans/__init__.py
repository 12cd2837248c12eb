"""harborline.plans"""
