"""Known whole licence texts, as digests of their canonical form, and SPDX identifiers.

Texts: those of /usr/share/common-licenses (with and without what follows their terms), and MIT,
BSD, ISC and 0BSD with their usual titles, list marks and disclaimed parties.  A text has up to
two digests: of ``body_text`` and of ``canonical_text``.  SPDX identifiers: licence list 3.27.0.
"""

# Licence and digests.
WHOLE = {
    "0BSD": (
        "25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c",
        "53695ed162cb0132fe0563719addeac105c8cad72350fae9183e2c74a7c0dbbe",
        "9c842909bcc85365ba7f0d106fccdc3af51784431076174588a9832837ebf153",
    ),
    "Apache-2.0": (
        "1d2490e65bade4b7cde700178105759a1eeb6ed401841c01b9ff35e40e55c5ad",
        "37599287c15c2f2ec060c3c3b55bdf69e3bc7a8aeeb9cd57e18800088789538a",
        "e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2",
        "e9dbf930ca0f1e090ec68da9a37b657d11bc9e43b30643455d6a96dbf73116ca",
        "f45538b138cf9aea39fa205de037a0bede8305e68281650e7ab809a8b3ebb2f0",
        "ff7be961361eda3cd2a76927dd0d9482cf45defafde2045befedf77400d98100",
    ),
    "Artistic-1.0-Perl": (
        "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702",
        "ddb49d591ecc4f65a223b9f53f330918100c323532a653c090d21b38e35a3a42",
    ),
    "BSD-2-Clause": (
        "09c2de3ccadab685d02695bec536d609c7245e0a5740ad66c90b61e4a0ccc557",
        "117fa84a7ffb2cb3a2ba7d18dd284e7283b034d6fb6c6419721ee4e28b5306fe",
        "1191d361e8d264ca003df647f25b08c2053f24574121b6734eaba3e9ec43b3d8",
        "1651bc793aace19c0bf1f3af67117f76c52361865933b8fe86860842946fb4ce",
        "1cd2d4d633195ae0e7223a94a138f2ffeb48b5c1e6cbc2bd997dfae4cd96abd6",
        "1d83c795cb55e0206af653887c5ffa588e7ef8dbf115559aeadfe50d6a1ff5b8",
        "1e519f8916dca74c89371617f4339d40a4ed3bb71e801c14aa72e8071bafaf81",
        "239190ee903aca2851ccd5099cd7954d026d60f9b9f98e391ca652499c6aaae1",
        "23d7258e25bd67982ccec4b5bfc05631a20f8ee5bd5fe7eb70694c100aae88d2",
        "33903615089fdb3ab02696d1bd92eb9580c2c7a0e0c8714aa95b0dfc1dcdb89c",
        "35360c12290df89c2afabb3c355069c6c3c3084353b9ea863a72e3649943cc6b",
        "3938f828c79910468f483f925e6a33217162693f71035d6044cbd04dc6fd1bd5",
        "3985ed359045fc509233306c101208276e2620b3f9b9635e2696ad2fe5e0f5ba",
        "3ca5194f17906afb0cdbf99b3c08b69eecb19c2f3b42883ffaa20b1fb4c65bd4",
        "447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2",
        "46ea32122204540f20eeb85d0161a4bd70fe00d3446d977a6e9e250039492072",
        "4a5b45ed3ca9ae854c5505a774b3659d3852be9a3412b822802b3cdbe5dc7b0a",
        "5151319f99abfc15f9a1aab05c799faf3b0e5715fac5a5812b9d3566ae984374",
        "5d123f3d2076a6b22f7b17a92623627ef50d1584e8cf13b7d4040f1c6e8a0424",
        "6a5d49c15e02e9e94957d78177d86e8631be9a19549a7cfd2e8c3be2699f00b9",
        "7be8178e4e9d0dea6ff4b04bd52bd086d7ea8386a5a6e09760df916bae5d42d2",
        "85c46767b6234227cebe127f5c22b9ede02ee48dda5f148ccefe8432c4d93221",
        "8b28f63734bf310903015ecd26ae5c979f31743ca170703b95426d7203774453",
        "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74",
        "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30",
        "a924d10cc9117ca3afe0da1977b555e0a5cdec705794a96968a88e5a75ab0282",
        "b02d799e391838a73a0ccc75692ba88eafccab18abbd5f907e855d22048655d4",
        "b5335fc56cb06fb488859427303188fdccfe901752d74938dbb3e63c952746a4",
        "b7d49d651647319f38c254df78d020e1c773cbac121d97b17eb70bf3149e7233",
        "c5cb44b340dfa97436d18371e401686dddf3451388afa1a24c0e410cd7a38b24",
        "d84a005d922ff41252b5c3805f568640e8f48bfaff78cebe44b6421b89496d1a",
        "e7a5dc9a060c8ff3ce2d12a4306f1cb153628adbb45aa72411f61c4ae415d36d",
        "e90608a663ae638023eb95a6ae359f7b6b865e6237fa832c48500c4e1af035b9",
        "e98ba176bc0e1674ce4eece758209c4ded026532e01fb881b22cb7eacf4b5137",
        "f660a20fd170fe8b6282213c3411227a553f1451ee95bd49ed6ca3abe7045314",
        "f9c0de945db946a0b06e8587a80b1b35b3f3e48a0f63cb64860eb4e433d32c7b",
    ),
    "BSD-3-Clause": (
        "02cbb88221e507a296bab4438d8c41fc55a45c1e486982b72971ef667bab440e",
        "08736309e21ef4f4f04fe8d65d940170f6dead365ae956175f9f925b68835df1",
        "09541ff2b848c3c2b2a943fc8a1da98fc6318f195f1a9b850ab6b8b54ea971cf",
        "0affa7cfd2992522d719cf3ffaea5eba471edfe2e7ef05eccea42819f076649a",
        "0d9569accbee32dd3a420896d10f915d23071d627b49ca2f194661b3fa6aa139",
        "0fbd7c43c4bb3e398d262b8e39f58ee0a8709a2b3b6b4bee4e033b3d5755f58d",
        "1157d7738c8e4b9714da26c13a27d402141a7cfc68c80f72c30fe25698134732",
        "13f9b0ee694f6ad6cb52e79ca5b46dba3c09c2eee46b802f0d1972d7401b8b3f",
        "19a4781693c27171941c3997100df63b3707e99f2135091c98fb3aba3429a921",
        "1df9653bc861bd2d04debc888c7520b12f8069da758fe64b63338ed87412a59f",
        "214aa9c28152d6d77e6bebfb4a7511e677f65fdaf94b0fe9c0bb580e0eaf8997",
        "2197427e156dd704210ae726a3807f7deae35bc31d7243168c575348f6a5419b",
        "27a2e1e89e7112620faea164ab107b2aa62736c29f8447674a19f27a4b44d972",
        "2862502b8c0b9e2898bddc193550da25efbe12dcc633cf5c250c8acd75d2fcfc",
        "2a4386d4ecdb97d143f06b73903fc9ff8f6c02d18e34a454e12468669d45c531",
        "326c317935b3409d9750fd4ad5326ce15c9b75d313b4baf2cb9ff54accf8d903",
        "33927fff79c9815dec59c6f9b542068e47756a9638e5f65ed558bf8a0bda6d2b",
        "381a1597c60970e78836bb7d9da99e690f5a6664751fe19cd5447f6bce238970",
        "3b00744424f4dd7fc2e085d326eb78eb3ca03e7d68b6eff32ea5ccdb52067926",
        "4241a91ed59fdc8d1c20d065984925429610744add02cce3becf94e4e83c49f9",
        "48074036d5eaf88e782a67b0c1153524026baff6af1025bb6355f8e66a4834c2",
        "4898509c3929c3aa032c13508986410d68ff1db07ca435c3de97b8ec26266df8",
        "496a88fb77f7cf55994de8bd2b87ac0e9302e2dc1b11f567dd0447f8f0648ab1",
        "4971b5139881b2e17ca5576967a0c5f617dba9cdea1259febcdce2310efe3551",
        "4af3efd27cc12d2146661de254afc90bde9fc2c708eddbfe69013f2c8cf24654",
        "4b4f06c6bb13b5bb8b80f010291833f65b369a356046370375f4b9be06c4632e",
        "4fec7901c0764f1c632da504aa28d5de5e7e5f0783c88d1e3fd21de4f97e315d",
        "52c8e1f1387429e4ac2e46a159e2b2d17320de20b05dce03cbd7a7cf9be73702",
        "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa",
        "54a11abe42208b3ea52a7682e9597e365d3170c949afe123c4a0ea6fd698cfe1",
        "5517639baf3af885e35562233a60f58c570b3fead9749a97d73364ac1177319f",
        "5a6e7ec0b1ac1e224277a8a6d5cd7691ea38298b0308b87a7a2e539d020ed1e0",
        "63ecc7b0dc015266ded3f3c7319a211f0914c98e38996a5575e4a5af0954492e",
        "652e44ec56b1a65e2b133e4c6598ea3f9c6d68f08b12762eccbb5626e883e1e7",
        "69083549410d2f63af7724cabe9383c3da756a9875b71a13bdf06f218d41d7cc",
        "6b526aa5ee6772e76522f9a9f192742da65ffdd1901707febaf423a9dbac917c",
        "6cded2d64ede823606e0ad912d43ef7cf641160926310fa31217c3749fa32aee",
        "70f92f35862f27c95a390cf57675d409d26cad237a81d89d1e4fd53bb8588730",
        "73a15ef51d0f74bce7fc4d1287b8d8a639c37581de7f63863957aea115dca7da",
        "7668aff13b074ee8ff72fe4d1e7a5866b755b8fc00cd0239e4e80aec12f32127",
        "7c16b387b2fd67aea7403110df9457eea9844b938eda62df5f98a56797001ccf",
        "7d02ae2c80c60cd70553447d29a51c4a74ef3a7bc857b1caa696871a9fd4eef3",
        "8078ca96ff592b24ba127e14c7f110f54057dcde2c6023deb34983ec3e23196c",
        "843924ffa8d5041559db06f32df9961b966113ff66489fbcffe1d5da98c253c5",
        "845ba3fce0ead2e85d28b60637f5fb13855d17a9671b18a047ea752007aba012",
        "84c781b5d7e3445d472ea78f86da8ce1f7cf3f8a699eed9e76e2fde2284fa9b6",
        "85a253fdca75357d8f16143d242204d0c291650df54bf470a94c229f0d848c65",
        "87574bfabab7a07be08238d1c4185b40a40b4cfdad93ce56f260b0da99b3192b",
        "879c3596747a6ef0bbee8e7043026b5c3b228545a440480109b8c20e779bb904",
        "888062e0a1f2a1e04290c0a56643cfb719645e4abc0a8b84c9377a65b733786e",
        "8a69b3ae3c37b6cf9ce330b5e5e3050e29100621d05ba8c828ff817e2e6556ef",
        "8ade638323b06be3951b2c6a8ac27489a02d9bce0b9baa223586a0136cc01098",
        "8ec96ac102a1a4e8a51586c5069c7bbf5b233cd4fd6c2e01ef2e376f9fbace63",
        "9489b436580d391282f8450d5cad80f742037929e8af66eae334bea36cb68d91",
        "94a0a44b170114affb7b3975c6987906dca819b6cbd93510aa70be57345a1e3f",
        "9904e4a8d0dd09f714bb80aacb2d5e71a816c4bca1587db5444acef8bebcfe39",
        "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2",
        "9b9ac51f5ca1f4f99ccf94a0770c77723a9b4a5eaf09e0de3f8c9ec65b1f396d",
        "9bbdb5a30a0244be7102fc982ff402cd1db43e5d498e2bdf02fa3a2d66257270",
        "9f60d63d1db0225adfe5a985d469fa08de8e1a27401cd0475ada5c0cd168bf03",
        "a65aa119a9ae25139c00daa069f0ba1397cbaf52bc0cb15bce536c93c866827a",
        "af94d2d40feb0ed95e33d8193bff511bdc49f2a7327aeb8b804da82613b4ec16",
        "b12dbf2374176f8bd3f97ff4c4a2a981ff44fc78f422307741a2d1fc6bd8aab5",
        "b6ab7953b6c80a72261014244324a70663f1807fa212f52461b24c95eb16b4a9",
        "bb17d1e78bbbe62ff8673ad110ea7261693b72f37d93bc54bebe3cb205e66ca8",
        "bc32292ca134d8d6afcab5ff5818ff538c0ce5ac32a60e7881e5d1e9d038552e",
        "bca982714b8b1651f5523ef4c9b4972254e795db23468ecaf67ced2b1f7ff224",
        "bd7d910c4d2db198970b03aa0712c2453834c2245727445d4d1552208efbd9be",
        "c19e45e4caf36d04a07032e4291ae19dfa1ba7a438b4d073c576d8271eb7dbd1",
        "c4c6bd260341f41bb3b13d241fc397efb442b188fbe8f2479e7c9b4d38015917",
        "c86d75bd19f935ac6c644509e3159cdd3a6b0519968c41dc09d8aa09542a9ffa",
        "cc3432eb2f19bb6fe96706bad75b6fce1039db64fb70486899bf6425dea4d9cb",
        "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15",
        "d28c60a1453af811878e30676849c6cba1a910cec37b1a68ed9cbd701fa890bf",
        "d3b3be4ec9c5c0af1c71fe9ec8d978dd5e0d478105b6276ecb2bcadc9fa4b707",
        "d4542b2c750ddc48ef799c19992beedb965469683f3ad3c4ecfee120fcf832c5",
        "d6257db4781e8531fee85c1cd8fe8adf06a6b7763ed73da1906a14d24925fc1d",
        "d82109ca031904db888330a0ab8c8987685e71f8dbff7393792df6d32b4ae712",
        "d99e526e448d31c7f35806b5e698b89aaeb7affb592cb0a6168fef06a1a09f74",
        "dc06088169d82bfb3bf20fa94566038849b41f0c772ebdf6cc13a92263873a65",
        "dd9c572087f92a74232343008a70468eeee08d97112450db549eb0fb33a8d29e",
        "e60143686f94bbff438ca8d1ec28b93f48dab068c458d943110c425586e89f38",
        "e612af111b0f62aac3e107973cd804ade8a118ba3c7034d6824ebdce9852ba2e",
        "eae5af925ef81a3f60f8853bef931a945e767ee641da76ba2ee9b55b53d002f5",
        "ebdea9b587b934d0ec46f02c5f7088f957b8c701b754cccae6e7a985f1e65819",
        "f3d52dc8e8f5c15a89383672ff45fa0138105faa3f4b53a4fbf5c26e4b221ee5",
        "f5e8212bdbf0465a5196123ad9b72a89f88bba7071a03c91b20f6ca41def6fd6",
        "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af",
        "fcfaca9856c9d06723391332be070f14157dc455699d40c8852a50b70f45fada",
        "fd690ba616f1a75c69b173d958d3840f12e0ac0e59ecc828f93a4961e07ff5e4",
    ),
    "CC0-1.0": (
        "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
    ),
    "GFDL-1.2": (
        "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71",
        "f06741c6c5feec30d99f80228f0d9ea6b884eae0e790ab18a0f4257184befa86",
    ),
    "GFDL-1.3": (
        "308a357adeb0d8a10fe0d0ff9bcc6322de39d728fd1073b64d31129a85a77f5a",
        "6f33c1fea6b4e2c3276ae8e374515f28815f379102edd5c8d33a05b42bed3883",
    ),
    "GPL-1.0": (
        "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc",
        "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70",
        "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224",
        "9e12a40a9b22c45d116f19e1746b08ea0b853519de3e03ceb780f2a36d5f388c",
    ),
    "GPL-2.0": (
        "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808",
        "a1e7ba14d8d85807f384435b77f91e925decc43da128311c991c4f2337e44017",
        "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1",
        "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34",
        "e4d14510e41435c3eb12c255b72546a3cb9943f06f209c72bc30a19095b08999",
        "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821",
    ),
    "GPL-3.0": (
        "0bfab56d550b40daa734fad2386cb4caf8527e34ff33eb85cf0f1a0aefbf5699",
        "1368b610356d98a8c46b121d129e8c15e265ad1924b43009b00f05509cdd93d8",
        "745ed2c32002634241835ba198c14bd7e62665512fc52ac0ea9b6be50e284ea8",
        "f4ee2e8ac2c4fe19ac18f934bcdd77b5cca8cf9a88caa00b2776d0a358bf876c",
        "f6e910952ff4741eb305128d599e488c6d0d321ffd70cd65bac3a2743fd8c8d3",
        "feed92b884fd7dae2afba366a8c6e0342b260acfe00d707f5db092cd9e9d3b5c",
    ),
    "ISC": (
        "217da0747cec63a2e734185db11cbaa819bcd9e5b83cd12f812128fffe66e26a",
        "23651ce8a73abaa8fad9143faad3fca843b5de6baf345008f65c453ea5685fb1",
        "280d76b420aeff51730e96577a2466120c91213f03dd50d60107078c498c5b29",
        "28b3b76e4bc702261e30cad89a6515298ec241a0ec504c0153b7c6910cd2f827",
        "2c5674d617d20196b487c7b0608b9c209df7c111c557c8207f2fad989914586b",
        "30fe7ddd14f7f6d7bce47da437bac0dc1a88496b90a9be0b1bad8404b114c011",
        "3bc64c579e24aef2632e96f86e99128bb87fc25e4e66c2c5a8df57b95dd78ade",
        "3c094e9c7072025f416c19903d3f8c435095de9b51bfac84d6c57e84483dcee9",
        "3d522e40b21fe47f1c0b4ba98d2813c76a08e24b8869559e32371e837ae9fa78",
        "40e6eb51c3b409d93549806b55b249c261dab149d19b56cc163624f39a08b1db",
        "571c6f1b092916ec5c47890bbd34b8d9b81d53924bf0295cce6fc61732751ea2",
        "673f59dc8ad54524704b5b5d2deeb39eec917afad46597b1b7d4f2963edff317",
        "68cd3b9a1779ba2e8eab1875d0cbaf9b66d4b5bb00a2d65f98d027ce9d50d2ba",
        "68cd7c6ef1c9e187b02f34a2baef27dbc18ed16bfc885c9f90003b2edeacee51",
        "7bed11ada181e6a63598e2da423080dd990b5647feaf0f67008662a131aec2c7",
        "7d47c94b4af140ca12f4f1c110474049aff8da3f4815d250577ff9a531541ec2",
        "8281b7122b87e54b97a6183786fef9b33350db9bfb9141855ea93e09543e1fcc",
        "8ee0d4f927294d5cfe44a2a4b1faecb347cc94d0e53edd910b1abc0f6527865f",
        "a78358e4932ba3093f235e64ea2769b9b05e4e6f17c4ad7ee404b2efbf5e1b3a",
        "b8bccf071a9e4caa2fa23a130c6e25fe4ed53dd1750c125e06a7712517f3a50e",
        "c8dc4820b7294d311a05f9458126f473d2e604645536d64bac2b3e70f83c6d3a",
        "dd20ca7f0f128eaf02cf7ecc69098fffb747ba179eba3e3735a73e67febfa360",
        "f172f90a892d869d5d840d5f4363218a9b21bdb1bd3925ba9c752d1660134fee",
        "f3588afc5bdc886b900e418605dca064c1e012ce6ec6ebbaa100d23f56c0c986",
    ),
    "LGPL-2.0": (
        "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2",
        "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260",
        "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908",
        "b4114daa3dfa52e27e78b2c4e17acd58bf4381e812762f4ded0bcb8eabd1092c",
        "e0de5033b5ad2a24c0a1a8b04f09e33038ffa62d2bef7178de2a3c6f5d56f499",
        "ff773d8d898dfc51ae2dbf3baa20700673e8ceb153b13d26c525af34a59adf0c",
    ),
    "LGPL-2.1": (
        "294fb9ec58649c7eb0cf90fc2900ac1b28b82fb6da9d40d7599d6b7d399d4d2e",
        "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4",
        "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891",
        "963f79d48038eed98d8341c84d8d3b765e99508a738d00654c0112f70a7c370c",
        "9bf9c99aeafbdbccd7456a00d574699e3deb41868375496cacbf170be719bebd",
        "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df",
    ),
    "LGPL-3.0": (
        "af4f466bab5554afad60c219ff8bf29eddb00df6ef0f1fcf73fa05ad4b3289f5",
    ),
    "MIT": (
        "0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c",
        "35a446201226de6b27cfb7106d0f6c697f63bfeac2913dcf89024911e66ef164",
        "6ad3654379e72bbdf8478d5c90fb1e2525aba033fbe675e0ef2248aac67c0f6f",
        "6c833965e9ca4cf8095655005226f24fe8bf7b1605dbe513204837a7371fa127",
        "7c3366b22b9f0d6a198b2c29bd1c4b663b2d55eacbd066146e5476c4b8ff1ce4",
    ),
    "MPL-1.1": (
        "1cfb6cca26abe2169c9c61164807107b2d4a0b64955a2cf2de46fad3483acda1",
        "26ba73e836ecb04fe87d5eca80ca27cff1afa2d7683455be1517bd23b8d27986",
    ),
    "MPL-2.0": (
        "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9",
        "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a",
    ),
}
# SPDX licence identifiers, deprecated ones included.
SPDX_IDS = tuple("""
0BSD 3D-Slicer-1.0 AAL ADSL AFL-1.1 AFL-1.2 AFL-2.0 AFL-2.1 AFL-3.0 AGPL-1.0 AGPL-1.0-only
AGPL-1.0-or-later AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later AMD-newlib AMDPLPA AML AML-glslang
AMPAS ANTLR-PD ANTLR-PD-fallback APAFML APL-1.0 APSL-1.0 APSL-1.1 APSL-1.2 APSL-2.0
ASWF-Digital-Assets-1.0 ASWF-Digital-Assets-1.1 Abstyles AdaCore-doc Adobe-2006
Adobe-Display-PostScript Adobe-Glyph Adobe-Utopia Afmparse Aladdin Apache-1.0 Apache-1.1
Apache-2.0 App-s2p Arphic-1999 Artistic-1.0 Artistic-1.0-Perl Artistic-1.0-cl8 Artistic-2.0
Artistic-dist Aspell-RU BSD-1-Clause BSD-2-Clause BSD-2-Clause-Darwin BSD-2-Clause-FreeBSD
BSD-2-Clause-NetBSD BSD-2-Clause-Patent BSD-2-Clause-Views BSD-2-Clause-first-lines
BSD-2-Clause-pkgconf-disclaimer BSD-3-Clause BSD-3-Clause-Attribution BSD-3-Clause-Clear
BSD-3-Clause-HP BSD-3-Clause-LBNL BSD-3-Clause-Modification BSD-3-Clause-No-Military-License
BSD-3-Clause-No-Nuclear-License BSD-3-Clause-No-Nuclear-License-2014
BSD-3-Clause-No-Nuclear-Warranty BSD-3-Clause-Open-MPI BSD-3-Clause-Sun BSD-3-Clause-acpica
BSD-3-Clause-flex BSD-4-Clause BSD-4-Clause-Shortened BSD-4-Clause-UC BSD-4.3RENO BSD-4.3TAHOE
BSD-Advertising-Acknowledgement BSD-Attribution-HPND-disclaimer BSD-Inferno-Nettverk
BSD-Protection BSD-Source-Code BSD-Source-beginning-file BSD-Systemics BSD-Systemics-W3Works
BSL-1.0 BUSL-1.1 Baekmuk Bahyph Barr Beerware BitTorrent-1.0 BitTorrent-1.1 Bitstream-Charter
Bitstream-Vera BlueOak-1.0.0 Boehm-GC Boehm-GC-without-fee Borceux Brian-Gladman-2-Clause
Brian-Gladman-3-Clause C-UDA-1.0 CAL-1.0 CAL-1.0-Combined-Work-Exception CATOSL-1.1 CC-BY-1.0
CC-BY-2.0 CC-BY-2.5 CC-BY-2.5-AU CC-BY-3.0 CC-BY-3.0-AT CC-BY-3.0-AU CC-BY-3.0-DE CC-BY-3.0-IGO
CC-BY-3.0-NL CC-BY-3.0-US CC-BY-4.0 CC-BY-NC-1.0 CC-BY-NC-2.0 CC-BY-NC-2.5 CC-BY-NC-3.0
CC-BY-NC-3.0-DE CC-BY-NC-4.0 CC-BY-NC-ND-1.0 CC-BY-NC-ND-2.0 CC-BY-NC-ND-2.5 CC-BY-NC-ND-3.0
CC-BY-NC-ND-3.0-DE CC-BY-NC-ND-3.0-IGO CC-BY-NC-ND-4.0 CC-BY-NC-SA-1.0 CC-BY-NC-SA-2.0
CC-BY-NC-SA-2.0-DE CC-BY-NC-SA-2.0-FR CC-BY-NC-SA-2.0-UK CC-BY-NC-SA-2.5 CC-BY-NC-SA-3.0
CC-BY-NC-SA-3.0-DE CC-BY-NC-SA-3.0-IGO CC-BY-NC-SA-4.0 CC-BY-ND-1.0 CC-BY-ND-2.0 CC-BY-ND-2.5
CC-BY-ND-3.0 CC-BY-ND-3.0-DE CC-BY-ND-4.0 CC-BY-SA-1.0 CC-BY-SA-2.0 CC-BY-SA-2.0-UK
CC-BY-SA-2.1-JP CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-3.0-AT CC-BY-SA-3.0-DE CC-BY-SA-3.0-IGO
CC-BY-SA-4.0 CC-PDDC CC-PDM-1.0 CC-SA-1.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CDL-1.0 CDLA-Permissive-1.0
CDLA-Permissive-2.0 CDLA-Sharing-1.0 CECILL-1.0 CECILL-1.1 CECILL-2.0 CECILL-2.1 CECILL-B CECILL-C
CERN-OHL-1.1 CERN-OHL-1.2 CERN-OHL-P-2.0 CERN-OHL-S-2.0 CERN-OHL-W-2.0 CFITSIO CMU-Mach
CMU-Mach-nodoc CNRI-Jython CNRI-Python CNRI-Python-GPL-Compatible COIL-1.0 CPAL-1.0 CPL-1.0
CPOL-1.02 CUA-OPL-1.0 Caldera Caldera-no-preamble Catharon ClArtistic Clips Community-Spec-1.0
Condor-1.1 Cornell-Lossless-JPEG Cronyx Crossword CryptoSwift CrystalStacker Cube D-FSL-1.0
DEC-3-Clause DL-DE-BY-2.0 DL-DE-ZERO-2.0 DOC DRL-1.0 DRL-1.1 DSDP DocBook-DTD DocBook-Schema
DocBook-Stylesheet DocBook-XML Dotseqn ECL-1.0 ECL-2.0 EFL-1.0 EFL-2.0 EPICS EPL-1.0 EPL-2.0
EUDatagrid EUPL-1.0 EUPL-1.1 EUPL-1.2 Elastic-2.0 Entessa ErlPL-1.1 Eurosym FBM FDK-AAC FSFAP
FSFAP-no-warranty-disclaimer FSFUL FSFULLR FSFULLRSD FSFULLRWD FSL-1.1-ALv2 FSL-1.1-MIT FTL Fair
Ferguson-Twofish Frameworx-1.0 FreeBSD-DOC FreeImage Furuseth GCR-docs GD GFDL-1.1
GFDL-1.1-invariants-only GFDL-1.1-invariants-or-later GFDL-1.1-no-invariants-only
GFDL-1.1-no-invariants-or-later GFDL-1.1-only GFDL-1.1-or-later GFDL-1.2 GFDL-1.2-invariants-only
GFDL-1.2-invariants-or-later GFDL-1.2-no-invariants-only GFDL-1.2-no-invariants-or-later
GFDL-1.2-only GFDL-1.2-or-later GFDL-1.3 GFDL-1.3-invariants-only GFDL-1.3-invariants-or-later
GFDL-1.3-no-invariants-only GFDL-1.3-no-invariants-or-later GFDL-1.3-only GFDL-1.3-or-later GL2PS
GLWTPL GPL-1.0 GPL-1.0+ GPL-1.0-only GPL-1.0-or-later GPL-2.0 GPL-2.0+ GPL-2.0-only
GPL-2.0-or-later GPL-2.0-with-GCC-exception GPL-2.0-with-autoconf-exception
GPL-2.0-with-bison-exception GPL-2.0-with-classpath-exception GPL-2.0-with-font-exception GPL-3.0
GPL-3.0+ GPL-3.0-only GPL-3.0-or-later GPL-3.0-with-GCC-exception GPL-3.0-with-autoconf-exception
Game-Programming-Gems Giftware Glide Glulxe Graphics-Gems Gutmann HDF5 HIDAPI HP-1986 HP-1989 HPND
HPND-DEC HPND-Fenneberg-Livingston HPND-INRIA-IMAG HPND-Intel HPND-Kevlin-Henney
HPND-MIT-disclaimer HPND-Markus-Kuhn HPND-Netrek HPND-Pbmplus HPND-UC HPND-UC-export-US HPND-doc
HPND-doc-sell HPND-export-US HPND-export-US-acknowledgement HPND-export-US-modify HPND-export2-US
HPND-merchantability-variant HPND-sell-MIT-disclaimer-xserver HPND-sell-regexpr HPND-sell-variant
HPND-sell-variant-MIT-disclaimer HPND-sell-variant-MIT-disclaimer-rev HTMLTIDY HaskellReport
Hippocratic-2.1 IBM-pibs ICU IEC-Code-Components-EULA IJG IJG-short IPA IPL-1.0 ISC ISC-Veillard
ImageMagick Imlib2 Info-ZIP Inner-Net-2.0 InnoSetup Intel Intel-ACPI Interbase-1.0 JPL-image JPNIC
JSON Jam JasPer-2.0 Kastrup Kazlib Knuth-CTAN LAL-1.2 LAL-1.3 LGPL-2.0 LGPL-2.0+ LGPL-2.0-only
LGPL-2.0-or-later LGPL-2.1 LGPL-2.1+ LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0+
LGPL-3.0-only LGPL-3.0-or-later LGPLLR LOOP LPD-document LPL-1.0 LPL-1.02 LPPL-1.0 LPPL-1.1
LPPL-1.2 LPPL-1.3a LPPL-1.3c LZMA-SDK-9.11-to-9.20 LZMA-SDK-9.22 Latex2e Latex2e-translated-notice
Leptonica LiLiQ-P-1.1 LiLiQ-R-1.1 LiLiQ-Rplus-1.1 Libpng Linux-OpenIB Linux-man-pages-1-para
Linux-man-pages-copyleft Linux-man-pages-copyleft-2-para Linux-man-pages-copyleft-var
Lucida-Bitmap-Fonts MIPS MIT MIT-0 MIT-CMU MIT-Click MIT-Festival MIT-Khronos-old
MIT-Modern-Variant MIT-Wu MIT-advertising MIT-enna MIT-feh MIT-open-group MIT-testregex MITNFA
MMIXware MPEG-SSG MPL-1.0 MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception MS-LPL MS-PL MS-RL MTLL
Mackerras-3-Clause Mackerras-3-Clause-acknowledgment MakeIndex Martin-Birgmeier McPhee-slideshow
Minpack MirOS Motosoto MulanPSL-1.0 MulanPSL-2.0 Multics Mup NAIST-2003 NASA-1.3 NBPL-1.0 NCBI-PD
NCGL-UK-2.0 NCL NCSA NGPL NICTA-1.0 NIST-PD NIST-PD-fallback NIST-Software NLOD-1.0 NLOD-2.0 NLPL
NOSL NPL-1.0 NPL-1.1 NPOSL-3.0 NRL NTIA-PD NTP NTP-0 Naumen Net-SNMP NetCDF Newsletr Nokia Noweb
Nunit O-UDA-1.0 OAR OCCT-PL OCLC-2.0 ODC-By-1.0 ODbL-1.0 OFFIS OFL-1.0 OFL-1.0-RFN OFL-1.0-no-RFN
OFL-1.1 OFL-1.1-RFN OFL-1.1-no-RFN OGC-1.0 OGDL-Taiwan-1.0 OGL-Canada-2.0 OGL-UK-1.0 OGL-UK-2.0
OGL-UK-3.0 OGTSL OLDAP-1.1 OLDAP-1.2 OLDAP-1.3 OLDAP-1.4 OLDAP-2.0 OLDAP-2.0.1 OLDAP-2.1 OLDAP-2.2
OLDAP-2.2.1 OLDAP-2.2.2 OLDAP-2.3 OLDAP-2.4 OLDAP-2.5 OLDAP-2.6 OLDAP-2.7 OLDAP-2.8 OLFL-1.3 OML
OPL-1.0 OPL-UK-3.0 OPUBL-1.0 OSET-PL-2.1 OSL-1.0 OSL-1.1 OSL-2.0 OSL-2.1 OSL-3.0 OpenPBS-2.3
OpenSSL OpenSSL-standalone OpenVision PADL PDDL-1.0 PHP-3.0 PHP-3.01 PPL PSF-2.0 Parity-6.0.0
Parity-7.0.0 Pixar Plexus PolyForm-Noncommercial-1.0.0 PolyForm-Small-Business-1.0.0 PostgreSQL
Python-2.0 Python-2.0.1 QPL-1.0 QPL-1.0-INRIA-2004 Qhull RHeCos-1.1 RPL-1.1 RPL-1.5 RPSL-1.0
RSA-MD RSCPL Rdisc Ruby Ruby-pty SAX-PD SAX-PD-2.0 SCEA SGI-B-1.0 SGI-B-1.1 SGI-B-2.0 SGI-OpenGL
SGP4 SHL-0.5 SHL-0.51 SISSL SISSL-1.2 SL SMAIL-GPL SMLNJ SMPPL SNIA SOFA SPL-1.0 SSH-OpenSSH
SSH-short SSLeay-standalone SSPL-1.0 SUL-1.0 SWL Saxpath SchemeReport Sendmail Sendmail-8.23
Sendmail-Open-Source-1.1 SimPL-2.0 Sleepycat Soundex Spencer-86 Spencer-94 Spencer-99
StandardML-NJ SugarCRM-1.1.3 Sun-PPP Sun-PPP-2000 SunPro Symlinks TAPR-OHL-1.0 TCL TCP-wrappers
TGPPL-1.0 TMate TORQUE-1.1 TOSL TPDL TPL-1.0 TTWL TTYP0 TU-Berlin-1.0 TU-Berlin-2.0 TermReadKey
ThirdEye TrustedQSL UCAR UCL-1.0 UMich-Merit UPL-1.0 URT-RLE Ubuntu-font-1.0 Unicode-3.0
Unicode-DFS-2015 Unicode-DFS-2016 Unicode-TOU UnixCrypt Unlicense Unlicense-libtelnet
Unlicense-libwhirlpool VOSTROM VSL-1.0 Vim W3C W3C-19980720 W3C-20150513 WTFPL Watcom-1.0
Widget-Workshop Wsuipa X11 X11-distribute-modifications-variant X11-swapped XFree86-1.1 XSkat
Xdebug-1.03 Xerox Xfig Xnet YPL-1.0 YPL-1.1 ZPL-1.1 ZPL-2.0 ZPL-2.1 Zed Zeeff Zend-2.0 Zimbra-1.3
Zimbra-1.4 Zlib any-OSI any-OSI-perl-modules bcrypt-Solar-Designer blessing bzip2-1.0.5
bzip2-1.0.6 check-cvs checkmk copyleft-next-0.3.0 copyleft-next-0.3.1 curl cve-tou diffmark dtoa
dvipdfm eCos-2.0 eGenix etalab-2.0 fwlw gSOAP-1.3b generic-xts gnuplot gtkbook hdparm iMatix jove
libpng-1.6.35 libpng-2.0 libselinux-1.0 libtiff libutil-David-Nugent lsof magaz mailprio man2html
metamail mpi-permissive mpich2 mplus ngrep pkgconf pnmstitch psfrag psutils python-ldap radvd
snprintf softSurfer ssh-keyscan swrule threeparttable ulem w3m wwl wxWindows xinetd
xkeyboard-config-Zinoviev xlock xpp xzoom zlib-acknowledgement
""".split())
