"""Digests of long published licence texts, whole and without what stands before and behind the terms.

licence, paragraphs, characters of the first paragraph in canonical form, SHA-256 of it, SHA-256 of all;
reckoned by licences.digests() from the texts as their stewards publish them.
"""

DIGESTS = [
    ("Apache-2.0", 26, 58, "93e3687e4f6d3361c07028c5c841dbe962c782ad1f86d4a2bd009e050751dc7b", "fb388936c12fba660a278043424b3f9a17c6b2e536674e390813ac3d06e7e73a"),
    ("Apache-2.0", 26, 68, "8f9a07cfc74f13faacedb4ef5f66671824f4db35b0becf50739f877003b330a7", "6aa661403864282a4d084f1551e8149a5f1a7b5e8b05b6db8e1a8a28d0badc64"),
    ("Apache-2.0", 32, 68, "8f9a07cfc74f13faacedb4ef5f66671824f4db35b0becf50739f877003b330a7", "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b"),
    ("Artistic-1.0-Perl", 28, 8, "9a9b9a1c3f54a244a0f9fe66967769d25f166dcd6209e2c205ef50915e683bdc", "4eaaa9e33aeef0af0ff83ab5edac0ad421a1da9cc861c564630460107b4b772c"),
    ("Artistic-1.0-Perl", 29, 20, "9fed8b0e06b2229a97a10906ed7a4e4608b849d85ed54da1ada55f2d05e8d9db", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("BSD-3-Clause", 3, 55, "ec2e63cb4fe19a43148ee55c37201eda2d176e50556dea2204831c96a69cd412", "2f8c6e1fbad71537ccf82be397287a98faf8d21ae0d307d8d0201874cbb6705e"),
    ("CC0-1.0", 10, 20, "258bc2759ea2cb9a64d69f2d91c7d8e4f1a88d1688b894fe7485b5d5c701ec58", "4f8ab63ace774f37529081c81e2730a88143bf70e67392bd3c3701bd0a175152"),
    ("CC0-1.0", 13, 27, "021f3f319970fcf1f6e1d478e5367d797699877f3434ad73ee1ef815fdc7cd63", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", 57, 56, "8d2eae4d251844e9a73f0504efb40de0122c63022a833e6e0f5caafcd8f04324", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.3", 67, 58, "f42b2e6807623175c74cf8ca228746283c01775b536214b79d00df84c9a65ffa", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GPL-1.0", 32, 8, "9a9b9a1c3f54a244a0f9fe66967769d25f166dcd6209e2c205ef50915e683bdc", "018aaaf7231e8a3c8e8a0800c7e593914a330040252f5dc554e1817d1a27f2d4"),
    ("GPL-1.0", 50, 50, "82397a16c2231c372bdd0ef728bd88bf794e7b7858a5ee5e95a390556acb8081", "eafda7cb5e995143f4d45ef2107eb160d6856afabed7c48b1b317303bc40a7e6"),
    ("GPL-2.0", 42, 8, "9a9b9a1c3f54a244a0f9fe66967769d25f166dcd6209e2c205ef50915e683bdc", "98e760555ff723908d803b23140ebd264fee15e7615bf9486faa0f8f6596c34f"),
    ("GPL-2.0", 59, 46, "800704d54279141c14d2b5236cc50e7ea885fc8220e3bdaa410f2b54971d7522", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", 107, 8, "9a9b9a1c3f54a244a0f9fe66967769d25f166dcd6209e2c205ef50915e683bdc", "fad6d14122ae5943ea05f9e4d48194524a0b701f034fd22c7dded3e6c296c742"),
    ("GPL-3.0", 122, 49, "10c3854c70c10808f2f455ff7ae311088ab9dd94c2c06693fb750f4c9e482943", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("LGPL-2.0", 68, 8, "9a9b9a1c3f54a244a0f9fe66967769d25f166dcd6209e2c205ef50915e683bdc", "d4689245f0c71022ce729821274153c787fdebe2e92f0de1f6d3c23326a5f619"),
    ("LGPL-2.0", 83, 54, "6ed1731e87010ecac4542e62634534a81feb95b467f42e6140f554e77f81aaf9", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", 70, 8, "9a9b9a1c3f54a244a0f9fe66967769d25f166dcd6209e2c205ef50915e683bdc", "73ac55304afe4c219acdd0cb7683daf4fe3772c9b493da4a095d93a7789311d5"),
    ("LGPL-2.1", 85, 59, "4de811fed3402b35cc931316356c984d20ec54d660630f4064c708984b91f51a", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", 35, 194, "5970fa0659dc97cf56a24259b94b6db0baa62cdee47d661ea0f04eb6faf1f411", "3c109b32fc12cedb18f514c338498353cbbafbc7ad3aa3aed8c864396943f25a"),
    ("LGPL-3.0", 37, 56, "b1dddaf7ef2e30067896bb2f11cf3c9defcf11564304f448a9257f49502a9e85", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", 73, 34, "e8d78c7ef0b7fb5f931ba9501977c8ca266cc1ab4b95b40fea21f3a7867310ca", "a1b36de49a400e3d3385d5987188db954a084f9876243aa7207cd91de3f24a7b"),
    ("MPL-2.0", 76, 13, "5e8200d69042fa63eaa665929691dfcc31c9c429a69a9c5659fdb8c74ff25e15", "8f27174c93cb7f68399e5e71af858fdef9c2151b9de96b0dd9bab40a165711b3"),
    ("MPL-2.0", 83, 34, "58c9a1c62b739e4bead89c80c6af62cd77999c648016e24ba011e53180a5cc15", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
    ("PSF-2.0", 8, 223, "578ed203631cee4bc125f611be67431d1c6376299905c214313dde3425d8ff90", "4bda023a69dfc888027300a4a76560cbadf52db6166559f7de336564f426cd10"),
]
